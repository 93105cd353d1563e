"""Near-duplicates by SimHash fingerprints.

Fingerprint: of all shingles of a text (repeats included) 64-bit XXH64 hashes are
taken; a bit is set if it is set in over half of them. Two fingerprints link at
``DISTANCE`` or fewer differing bits; components of links are the groups.

Links are found in an embedding. A fingerprint is cut into 32 segments of two bits,
and becomes the vector of their bit counts. The Manhattan distance of two vectors is
at most the Hamming distance of the fingerprints, so linked fingerprints lie
within Manhattan distance ``DISTANCE`` = 3. The segments form ``GROUPS`` groups; vectors within
distance 3 differ in three groups at most, so they share a cell of one of the grids that
``GROUPS`` - 3 of the groups span. What meets in a cell is compared by
Manhattan distance of the whole vectors first, then exactly. A grid over 20 of
32 segments keeps chance meetings rare (2 in 10 million pairs of random fingerprints).

Only distinct fingerprints take part, so exact copies count once. A cell puts out
no more links than members: a spanning forest of its links. Cells of more than
``BLOCK`` members are split into blocks, and each pair of blocks is a task's group of
its own, so that no group of rows grows with the data.

Where whole rows are returned (``one_of_each``), they are shelved first and never shuffled:
only ids and fingerprints move, and the ids that stay come back to the rows.

Defined cases: a null or empty text, or one without words, has fingerprint zero; rows
with a null doc_id link like others, and a component's id is its smallest non-null
doc_id (null if there is none). Repeated rows stay; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.llm.components import components
from salesprep.llm.shared import longs, met, raw_texts, shelve, slices, stage
from salesprep.staging import scope

SEED = 42
DISTANCE = 3
GROUPS = 8
BLOCK = 20_000
#: Shingles whose bits are summed at once.
CHUNK = 1 << 14


def fingerprint(text: bytes, n: int) -> int:
    """SimHash of the shingles of ``n`` words; words are what white space (space, 9 to 13) separates."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    last = ends[min(n, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, len(last))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.flatnonzero(counts * 2 > len(hashes))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, shingle: int, text: str, name: str) -> DataFrame:
    """All columns and the fingerprint of ``text``, a signed long, as ``name``."""
    place = docs.columns.index(text)
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, shingle) for t in raw_texts(batch[place])], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, longs(found.view(np.int64))], names=[*batch.schema.names, "fp"])

    schema = T.StructType([*numbered.schema.fields, T.StructField("fp", T.LongType())])
    return numbered.mapInArrow(run, schema).toDF(*docs.columns, name)


def embed(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the 2-bit segments, in the places of the segments."""
    mask = np.uint64(0x5555555555555555)
    return (fps & mask) + ((fps >> np.uint64(1)) & mask)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of embedded vectors (fields of two bits with values 0 to 2)."""
    low = np.uint64(0x5555555555555555)
    high = np.uint64(0xAAAAAAAAAAAAAAAA)
    # field differences: 1 if the values differ, one more if they are 0 and 2
    differ = a ^ b
    odd = (a ^ b) & low
    far = (differ & high) >> np.uint64(1) & ~odd & low
    return np.bitwise_count(odd) + 2 * np.bitwise_count(far)


#: Bits of the embedding that each grid keeps.
GRIDS = tuple(sum(0xFF << (8 * g) for g in kept) for kept in combinations(range(GROUPS), GROUPS - DISTANCE))


def cells(fps: np.ndarray) -> np.ndarray:
    """Cells of fingerprints, a row for each and a column for each grid."""
    vectors = embed(fps)[:, None] & np.array(GRIDS, np.uint64)
    return (vectors + np.arange(len(GRIDS), dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)


def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            fps = part["fp"].to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([longs(cells(fps).view(np.int64).ravel()), longs(np.repeat(fps.view(np.int64), len(GRIDS)))], names=["cell", "fp"])


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs link: the lower bound first, then the exact distance of those it leaves."""
    near = manhattan(embed(a), embed(b)) <= DISTANCE
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= DISTANCE
    return near


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of links among the members of one cell."""
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    vectors, edges = embed(fps), []
    for i in range(len(fps) - 1):
        near = np.flatnonzero(manhattan(vectors[i], vectors[i + 1 :]) <= DISTANCE) + i + 1
        for j in near[np.bitwise_count(fps[i] ^ fps[near]) <= DISTANCE].tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                edges.append((int(fps[i]), int(fps[j])))
    return edges


def to_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows that come in order of (cell, part)."""
    kept: list[np.ndarray] = [np.zeros(0, np.int64) for _ in range(3)]

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        cell, part, fp = columns
        fp = fp.view(np.uint64)
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(cell)))
        pairs = starts[sizes == 2]
        pairs = pairs[close(fp[pairs], fp[pairs + 1])]
        edges = list(zip(fp[pairs].tolist(), fp[pairs + 1].tolist(), strict=True))
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            edges += forest(fp[s : s + n])
        ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([longs(ends[:, 0]), longs(ends[:, 1])], names=["a", "b"])

    for batch in batches:
        new = [np.concatenate([old, batch[c].to_numpy()]) for old, c in zip(kept, ("cell", "part", "fp"), strict=True)]
        same = (new[0] == new[0][-1]) & (new[1] == new[1][-1])
        cut = len(same) if not same.any() else int(np.argmax(same))
        if cut:
            yield links([c[:cut] for c in new])
        kept = [c[cut:] for c in new]
    if len(kept[0]):
        yield links(kept)


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that span the components of links among distinct fingerprints (column fp)."""
    spread = nodes.mapInArrow(to_cells, "cell long, fp long")
    spread = stage(spread, "simhash-cells")
    # cells are counted only in buckets of cells that hold enough rows for a crowded one
    buckets = max(1024, 10 * spread.count() // BLOCK)
    bucketed = spread.select("cell", F.pmod(F.xxhash64("cell"), F.lit(buckets)).alias("bucket"))
    full = bucketed.groupBy("bucket").count().where(F.col("count") > BLOCK).select("bucket")
    crowded = bucketed.join(full, "bucket", "left_semi").groupBy("cell").count().where(F.col("count") > BLOCK)
    crowded = stage(crowded.select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "simhash-crowded")
    met = spread.join(crowded, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    # a member of block b of k meets each block once: the groups of the pairs (b, 0..k-1)
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, block) * F.col("blocks") + F.greatest(x, block))
    split = met.where("blocks > 1").select("cell", F.explode(meets).alias("part"), "fp")
    met = met.where("blocks = 1").select("cell", F.lit(0).cast("long").alias("part"), "fp").unionByName(split)
    count = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(count, "cell", "part").sortWithinPartitions("cell", "part", "fp")
    return dealt.mapInArrow(to_links, "a long, b long").distinct()


def rooted(rows: DataFrame) -> DataFrame:
    """fp, root (of its component) and first (smallest doc) of the distinct fingerprints of rows (doc, fp)."""
    with scope(rows.sparkSession) as run:
        nodes = stage(rows.groupBy("fp").agg(F.min("doc").alias("first")), "simhash-nodes")
        roots = components(stage(links(nodes.select("fp")), "simhash-links"))
        named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
        found = stage(named, "simhash-rooted")
        run.keep(found)
    return found


def groups(docs: DataFrame, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("t"))
    rows = stage(fingerprints(source, shingle, "t", "fp").select("doc", "fp"), "simhash-rows")
    found = rooted(rows)
    ids = found.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = found.join(ids, "root").select("fp", "component_id")
    return rows.join(labelled, "fp").select(F.col("doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that with the smallest doc_id, nulls last; of equal ids any one."""
    names = docs.columns
    with scope(docs.sparkSession) as run:
        shelf = shelve(docs, "simhash-shelf")
        source = shelf.select(F.col(f"c{names.index(doc_id)}").cast("long").alias("doc"), "row", F.col(f"c{names.index(text)}").alias("t"))
        rows = stage(fingerprints(source, shingle, "t", "fp").select("doc", "fp", "row"), "simhash-rows")
        found = rooted(rows.select("doc", "fp")).select("fp", "root")
        order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
        first = rows.groupBy("fp").agg(F.min(order).alias("first")).join(found, "fp").groupBy("root").agg(F.min("first").alias("first"))
        keepers = stage(first.select(F.col("first.row").alias("row")), "simhash-keepers")
        run.keep(shelf, keepers)
    return met(shelf, keepers, "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
