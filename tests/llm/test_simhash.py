import numpy as np
import pytest
import xxhash

from salesprep.llm import simhash
from salesprep.llm.components import components
from salesprep.llm.queries import QUERIES


def plain_fingerprint(text, n):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """component_id of (doc_id, fingerprint) rows, comparing all with all."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fps = np.array([f for _, f in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 3) + i + 1:
            parent[root(int(j))] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(rows))]


def bag(rows):
    return sorted(rows, key=repr)


def check(found, source, shingle):
    rows = [(d, plain_fingerprint(t, shingle)) for d, t in source]
    want = [(d, f"{f:016x}", c) for (d, f), c in zip(rows, plain_components(rows), strict=True)]
    assert bag(tuple(r) for r in found.collect()) == bag(want)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(QUERIES["op4_simhash"](spark, sf), docs, 3)


def test_awkward_and_empty(spark, awkward, empty):
    check(simhash.groups(awkward, 3), awkward.select("doc_id", "text").collect(), 3)
    assert simhash.groups(empty).count() == 0


def test_crowded_cells_are_split_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 5)
    fps = [0x0F0F0F0F0F0F0F0F ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert {r.root for r in components(edges).collect()} == {min(fps)}
    assert components(edges).count() == len(fps) - 1


def test_fingerprints_across_a_null_doc_id_link(spark, monkeypatch):
    far = [0, 0b111, 0b111111]
    rows = spark.createDataFrame([(7, far[0]), (None, far[1]), (9, far[2])], "doc long, fp long")
    found = simhash.rooted(rows).collect()
    assert len({r.root for r in found}) == 1


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_near_fingerprints_share_a_cell(bits):
    rng = np.random.default_rng(bits)
    for x in rng.integers(0, 1 << 64, 200, np.uint64).tolist():
        y = x
        for b in rng.choice(64, bits, replace=False).tolist():
            y ^= 1 << b
        a, b = simhash.cells(np.array([x, y], np.uint64))
        assert set(a.tolist()) & set(b.tolist())


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 1 << 64, (2, 1000), np.uint64)
    counts = lambda x: [[(int(v) >> (2 * s) & 3).bit_count() for s in range(32)] for v in x]
    want = np.abs(np.array(counts(a)) - np.array(counts(b))).sum(axis=1)
    found = simhash.manhattan(simhash.embed(a), simhash.embed(b))
    assert (found == want).all() and (found <= np.bitwise_count(a ^ b)).all()


def test_one_of_each_group_stays(spark, awkward, empty):
    kept = simhash.one_of_each(awkward, 3)
    assert kept.columns == awkward.columns
    ids = [r.component_id for r in simhash.groups(awkward, 3).collect()]
    found = [r.doc_id for r in kept.collect()]
    assert sorted(found) == sorted(set(ids))
    assert simhash.one_of_each(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, 501: 500}
