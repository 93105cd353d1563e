"""The trie against one built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesprep.llm import prefix_trie
from salesprep.llm.prefix_trie import RESULT

FIELDS = "conv_id long, turn long, role string, text string, path string, node string, `range` string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    """Turns (role, text) of each conversation."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            held[conv].append(((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}")), role, text))
    return {c: [(r, t) for _, r, t in sorted(x)] for c, x in held.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(c - 100 * int(c / 100)), [])[:h] + own[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return {
        (
            min(held),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(held),
            len(children[node]),
            leaves[node],
            saved[node],
            sha(",".join(str(c) for c in sorted(held) if len(convs[c]) == len(node))),
        )
        for node, held in members.items()
    }


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], FIELDS).repartition(4)


def found(df):
    rows = [tuple(r[c] for c in RESULT) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, convs=400):
    """Conversations of few different turns; a third are copies of one, and half share their first turn."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 2000), convs):
        if c % 3 == 0:
            turns = [("user", "same"), ("assistant", "same answer"), ("user", "same end")]
        else:
            turns = [("user", rng.choice(["same", "same", "other", "é日本"]))]
            turns += [(rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randint(1, 3)) for _ in range(rng.randint(0, 7))]
        rows += [(c, i, *x) for i, x in enumerate(turns)]
    return rows


@pytest.mark.parametrize("ranges", [1, 2, 13, 90])
def test_against_plain_trie(spark, ranges):
    rows = random_rows(ranges)
    convs = prefix_trie.conversations(frame(spark, rows))
    assert found(prefix_trie.nodes(convs, ranges)) == trie(ordered(rows))


@pytest.mark.parametrize("ranges", [1, 40])
def test_rebuilt_conversations(spark, ranges):
    rows = random_rows(ranges + 7, 900)
    convs = prefix_trie.rebuilt(prefix_trie.conversations(frame(spark, rows)))
    expected = rebuilt(ordered(rows))
    assert any(not path for path in expected.values())
    assert found(prefix_trie.nodes(convs, ranges)) == trie(expected)


def test_awkward_turns(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "a"), (1, 0, None, "a"), (1, 2, "user", None), (1, 2, "a", "tie"), (1, 2, "b", "tie"),
        (2, 1, "user", "first"), (3, 1, "userf", "irst"), (4, 1, None, None), (4, None, "", ""), (5, 1, "", ""), (None, 1, "user", "first"),
        *((6, i, "user", "long " * 2000) for i in range(150)), *((7, i, "user", "long " * 2000) for i in range(149)),
    ]
    expected = trie(ordered(rows))
    for ranges in (1, 5):
        assert found(prefix_trie.nodes(prefix_trie.conversations(frame(spark, rows)), ranges)) == expected


def test_empty_table(spark):
    none = frame(spark, [(1, 1, "", "")]).where("conv_id > 1")
    assert prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.conversations(none))).collect() == []


def test_ends_of_shared_nodes_come_in_blocks(monkeypatch):
    """Two ranges of one path: their ids are hashed in order, block by block."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    path = b"k" * 16
    children = {(0, path): 1}
    batches = []
    for number, ids in enumerate((range(10), range(10, 14))):
        walk = prefix_trie.Walk(children)
        for c in ids:
            walk.add(number, c, path, [5])
        walk.close()
        batches.append(walk.batch())
    rows = [r for r in pa.Table.from_batches(batches).to_pylist() if r["kind"] == prefix_trie.ENDS]
    assert [len(r["ids"]) // 8 for r in rows] == [3, 3, 3, 1, 3, 1]
    ordered_rows = pa.RecordBatch.from_pylist(sorted(rows, key=lambda r: (r["node"], r["range"], r["block"])), schema=batches[0].schema)
    digests = [x for b in prefix_trie.hashed(iter([ordered_rows])) for x in b.to_pylist()]
    assert digests == [{"node": 1, "ends": sha(",".join(map(str, range(14))))}]


def test_hot_path_lies_in_several_ranges(spark):
    rows = [(c, 0, "user", "hot") for c in range(1000)]
    paths = prefix_trie.conversations(frame(spark, rows)).select("conv_id", F.unhex(F.col("turns")[0]["key"]).alias("path"))
    skeleton, ranges = prefix_trie.skeleton_of(paths, 20)
    assert ranges == 20 and len(skeleton.splitters) > 15 and len(skeleton.parents) == 2
