"""Trie of the common beginnings of conversations, by splitters and a skeleton.

A conversation is a path: one key for each turn, the first 16 bytes of the SHA-256 of its role and text. A
node is a distinct beginning of paths; its members are the conversations that begin with it. Texts are
not moved: each turn sends its key and its number of code points.

Rows (path, conv_id) are dealt out by ranges. Splitters between the ranges come from a sample, and the trie of the
splitters' paths, the skeleton, is broadcast. Rows that begin alike are neighbours in the order, so a
node whose members lie in more than one range has a splitter among them that begins with it: all
other nodes are complete in one range. A task goes through its sorted rows with a stack, finishes
those nodes and gives partial aggregates of the skeleton's nodes, which are summed over the ranges
and then from the leaves of the skeleton to its root. As ``conv_id`` is part of the order, equal
paths, however many, are split over ranges as well.

The digest of a node's ends is taken where its rows lie, in their order; for nodes of the skeleton
the ids come in packed blocks of ``BLOCK``, in order of range, and are hashed as a stream, as SHA-256
can only be taken from first to last. No group of rows is held in memory: a stack holds one path, and the rows of a
node's children until their parent's smallest member is known, within one range.

What grows with the number of ranges: the sample (``SAMPLES`` rows a range) and the skeleton (at most
``SPLITTER_TURNS`` nodes a range, as splitters are cut to so many turns). The ranges are bounded by
``RANGES``, so both are bounded. Any splitters give right results.

Defined cases: turns without a conv_id belong to no conversation; null turns come first, equal turns in
order of their keys; a null role or text is empty; repeated rows are turns of their own; conversations
without turns (after ``rebuilt``) end at the root. An empty table has no nodes. Other columns of the input are not used. A conversation is a record and is
read whole by one task: 32 bytes a turn.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.llm.shared import slices, stage

KEY = 16
#: Rows of a range, ranges at most, rows of the sample for each, turns of a splitter.
RANGE_ROWS, RANGES, SAMPLES, SPLITTER_TURNS = 250_000, 20_000, 20, 64
#: Ids of a block of ends.
BLOCK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()

#: Kinds of the rows that ranges give.
NODE, PART, ENDS = 0, 1, 2
FIELDS = {
    "kind": pa.int32(),
    "node": pa.int32(),
    "range": pa.int32(),
    "block": pa.int32(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "chars": pa.int64(),
    "ends_sha256": pa.string(),
    "ids": pa.binary(),
}
SCHEMA = "kind int, node int, range int, block int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, ends_sha256 string, ids binary"
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_key(role: Column, text: Column) -> Column:
    """Key of a turn as 32 hex digits; the role's length keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY)


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and turns (array of key, chars) of each conversation, its turns in order."""
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    place = F.col(turn).cast("long")
    one = F.struct(place.isNotNull().alias("known"), place.alias("turn"), turn_key(r, t).alias("key"), F.length(t).alias("chars"))
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), one.alias("x")).where("conv_id IS NOT NULL")
    in_order = F.array_sort(F.collect_list("x"))
    return rows.groupBy("conv_id").agg(F.transform(in_order, lambda x: F.struct(x["key"].alias("key"), x["chars"].alias("chars"))).alias("turns"))


def rebuilt(convs: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % ``group``; h is the crc32 of c, 0 to ``most``."""
    convs = stage(convs, "trie-own")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    base = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    keyed = convs.select("*", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    first = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), F.col("h"))).otherwise(F.slice("turns", F.lit(1), F.lit(0)))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return keyed.join(base, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


@dataclass
class Skeleton:
    """Trie of the splitters' paths: parent of each node (the root is 0) and children by node and key."""

    splitters: list[tuple[bytes, int]]
    parents: list[int] = field(default_factory=lambda: [-1])
    children: dict[tuple[int, bytes], int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for path, _ in self.splitters:
            node = 0
            for i in range(0, len(path), KEY):
                at = (node, path[i : i + KEY])
                if at not in self.children:
                    self.children[at] = len(self.parents)
                    self.parents.append(node)
                node = self.children[at]


def skeleton_of(paths: DataFrame, ranges: int | None = None) -> tuple[Skeleton, int]:
    """Skeleton of evenly spaced splitters of a sample, and the number of ranges."""
    conf = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = paths.count()
    ranges = ranges or min(RANGES, max(conf, -(-rows // RANGE_ROWS)))
    share = min(1.0, SAMPLES * ranges / max(rows, 1))
    drawn = paths.select(F.substring("path", 1, KEY * SPLITTER_TURNS).alias("path"), "conv_id")
    found = sorted((bytes(r.path), r.conv_id) for r in drawn.sample(share, seed=1).collect())
    picked = sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []
    return Skeleton(picked), ranges


class Node:
    __slots__ = ("chars", "children", "ends", "first", "leaves", "members", "node", "saved", "sha", "waiting")

    def __init__(self, node: int, chars: int) -> None:
        self.node, self.chars = node, chars
        self.first, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.sha, self.ends, self.waiting = None, [], []


class Walk:
    """One range, its rows in order: complete nodes, and parts of the skeleton's nodes."""

    def __init__(self, children: dict[tuple[int, bytes], int]) -> None:
        self.known, self.range, self.blocks = children, 0, 0
        self.path, self.stack, self.rows = b"", [Node(0, 0)], []

    def add(self, number: int, conv: int, path: bytes, chars: list[int]) -> None:
        self.range = number
        common = 0
        while common < len(path) and path[common : common + KEY] == self.path[common : common + KEY]:
            common += KEY
        while len(self.stack) > common // KEY + 1:
            self.pop()
        for i in range(common, len(path), KEY):
            above = self.stack[-1].node
            node = self.known.get((above, path[i : i + KEY]), -1) if above >= 0 else -1
            self.stack.append(Node(node, chars[i // KEY]))
        self.path, top = path, self.stack[-1]
        top.members += 1
        top.first = conv if top.first is None else min(top.first, conv)
        if top.node >= 0:
            top.ends.append(conv)
            if len(top.ends) == BLOCK:
                self.block(top)
        elif top.sha is None:
            top.sha = hashlib.sha256(b"%d" % conv)
        else:
            top.sha.update(b",%d" % conv)

    def block(self, x: Node) -> None:
        self.rows.append((ENDS, x.node, self.range, self.blocks, *repeat(None, 9), np.array(x.ends, "<i8").tobytes()))
        x.ends, self.blocks = [], self.blocks + 1

    def pop(self) -> None:
        x, depth = self.stack.pop(), len(self.stack)
        above = self.stack[-1] if self.stack else None
        if above:
            above.members += x.members
            above.first = x.first if above.first is None else min(above.first, x.first)
        self.rows += [(*row[:6], x.first, *row[7:]) for row in x.waiting]
        if x.node >= 0:
            if x.ends:
                self.block(x)
            self.rows.append((PART, x.node, self.range, None, x.first, depth, None, x.members, x.children, x.leaves, x.saved, x.chars, None, None))
            return
        leaves, saved = x.leaves if x.children else 1, x.saved + (x.members - 1) * x.chars
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        row = (NODE, above.node, self.range, None, x.first, depth, None, x.members, x.children, leaves, saved, None, x.sha.hexdigest() if x.sha else NO_ENDS, None)
        # a parent of the skeleton is named by its number, another by its smallest member, once that is known
        (self.rows if above.node >= 0 else above.waiting).append(row)

    def close(self) -> None:
        # a range without rows has an untouched root only
        while len(self.stack) > 1 or (self.stack and self.stack[0].members):
            self.pop()

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FIELDS.values(), strict=True)], names=list(FIELDS))


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's ends, of blocks that come in order."""
    node, sha = None, None
    for batch in batches:
        for at, raw in zip(batch["node"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            text = b",".join(b"%d" % i for i in np.frombuffer(raw, "<i8").tolist())
            if at == node:
                sha.update(b"," + text)
                continue
            if sha:
                yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int32()), "ends": [sha.hexdigest()]})
            node, sha = at, hashlib.sha256(text)
    if sha:
        yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int32()), "ends": [sha.hexdigest()]})


def reduced(spark: SparkSession, skeleton: Skeleton, parts: DataFrame) -> DataFrame:
    """The skeleton's nodes with their totals: sums over the ranges, then from the leaves to the root."""
    sums = parts.groupBy("node").agg(
        F.min("conv_id"), F.max("depth"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("chars")
    )
    # one row for each node of the skeleton, which the driver made
    found = {r[0]: list(r)[1:] for r in sums.collect()}
    rows = []
    for node in sorted(found, reverse=True):
        first, depth, members, children, leaves, saved, chars = found[node]
        leaves, saved = leaves if children else 1, saved + (members - 1) * chars
        above = found.get(skeleton.parents[node])
        if above:
            above[3] += 1
            above[4] += leaves
            above[5] += saved
        rows.append((node, first, depth, above and above[0], members, children, leaves, saved))
    return spark.createDataFrame(rows, "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")


def nodes(convs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every node of the trie of ``convs`` (conv_id, one row each, and turns): see ``RESULT``.

    conv_id is a node's smallest member, n_leaves the childless nodes below it or itself, and saved_tokens the sum over it and all nodes
    below it of (members - 1) times the code points of the node's last text.
    """
    spark = convs.sparkSession
    path = F.unhex(F.array_join(F.transform("turns", lambda x: x["key"]), ""))
    paths = stage(convs.select("conv_id", path.alias("path"), F.transform("turns", lambda x: x["chars"].cast("long")).alias("chars")), "trie-paths")
    skeleton, ranges = skeleton_of(paths, ranges)
    shared = spark.sparkContext.broadcast((skeleton.splitters, skeleton.children))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters, _ = shared.value
        for batch in slices(batches):
            at = [bisect_right(splitters, x) for x in zip(batch["path"].to_pylist(), batch["conv_id"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "range"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = Walk(shared.value[1])
        for batch in slices(batches):
            for row in zip(*(batch[c].to_pylist() for c in ("range", "conv_id", "path", "chars")), strict=True):
                at.add(*row)
            yield at.batch()
        at.close()
        yield at.batch()

    dealt = paths.mapInArrow(number, "conv_id long, path binary, chars array<long>, range int").repartitionById(ranges, F.col("range"))
    rows = stage(dealt.sortWithinPartitions("range", "path", "conv_id").mapInArrow(walk, SCHEMA), "trie-rows")
    skeleton_rows = reduced(spark, skeleton, rows.where(F.col("kind") == PART))
    blocks = rows.where(F.col("kind") == ENDS).select("node", "range", "block", "ids")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = blocks.repartition(tasks, "node").sortWithinPartitions("node", "range", "block").mapInArrow(hashed, "node int, ends string")
    above = skeleton_rows.select("node", F.col("conv_id").alias("above"))
    complete = rows.where(F.col("kind") == NODE).drop("kind").join(F.broadcast(above), "node", "left")
    complete = complete.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*RESULT)
    shared_nodes = ends.join(F.broadcast(skeleton_rows), "node", "right").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    return complete.unionByName(shared_nodes.select(*RESULT))
