"""Packing by minimum slack against plain tokenizing, and its choices against all multisets."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salesprep.llm import slack_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(fill, length=2048):
    return 0 if fill & (fill - 1) == 0 else length - fill


def check_rows(rows, texts, length=2048):
    """Each id lies in one piece, sequences have no gaps and no padding, and a sequence cuts one document at most."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    cuts = 0
    for i, held in pieces.items():
        at = 0
        for r in sorted(held, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(ids[i][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[i])
        cuts += len(held) - -(-at // length)
    for held in sequences.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length and padding(at, length) == 0
    total = sum(map(len, ids.values()))
    assert len(sequences) <= total // length + 11
    assert cuts <= len(sequences)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=5), st.integers(0, 60))
def test_largest_sum(counts, room):
    taken = slack_packing.best_sum(counts, sorted(counts), room)
    assert all(taken[size] <= counts[size] for size in taken)
    sums = (sum(n * size for n, size in zip(ns, counts, strict=True)) for ns in product(*(range(c + 1) for c in counts.values())))
    assert sum(size * n for size, n in taken.items()) == max(s for s in sums if s <= room)


def packed(sizes, length, last=True):
    """Rows of a packer that is given one document of each size."""
    packer = slack_packing.Packer(length, 0, False)
    for doc, size in enumerate(sizes):
        packer.add(doc, 0, size, np.arange(size, dtype=np.uint32))
    packer.close(last)
    return packer.rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=60))
def test_nothing_is_padded_and_nothing_lost(sizes):
    rows = packed(sizes, 64)
    fills, parts = Counter(), defaultdict(list)
    for doc, start, size, crc, _, sequence, offset, _ in rows:
        assert offset == fills[sequence]
        fills[sequence] += size
        parts[doc].append((start, size))
        assert crc == zlib.crc32(np.arange(start, start + size, dtype="<u4").tobytes())
    for doc, size in enumerate(sizes):
        at = 0
        for start, n in sorted(parts[doc]):
            assert start == at
            at += n
        assert at == size
    assert all(f <= 64 and f & (f - 1) == 0 for f in fills.values())
    assert sum(f == 64 for f in fills.values()) == sum(sizes) // 64


def test_documents_are_cut_only_where_no_multiset_fits():
    sizes = [40, 24, 32, 32, 50, 14, 64, 10, 10, 44]
    rows = packed(sizes, 64)
    assert len(rows) == len(sizes) and len({r[5] for r in rows}) == 5
    rows = packed([48] * 4, 64)
    assert len({r[5] for r in rows}) == 3 and len(rows) == 6


def test_full_buffers(monkeypatch):
    monkeypatch.setattr(slack_packing, "BUFFER_TOKENS", 1000)
    monkeypatch.setattr(slack_packing, "BUFFER_PIECES", 30)
    sizes = np.random.default_rng(3).integers(1, 200, 400).tolist()
    rows = packed(sizes, 64, last=False)
    waiting = [r for r in rows if r[5] is None]
    assert sum(r[2] for r in waiting) < 64 and all(r[7] is not None for r in waiting)
    assert sum(r[2] for r in rows) == sum(sizes)
    # equal lengths never fill a window, so the buffer must cut
    rows = packed([48] * 300, 64)
    assert sum(r[2] for r in rows) == 48 * 300


def test_awkward_documents(spark, awkward):
    rows = slack_packing.pack(awkward.repartition(5), PATH).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(r.doc_id for r in awkward.collect())
    single = awkward.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in single.select("doc_id", "text").collect()}
    check_rows(slack_packing.pack(single.repartition(5), PATH).collect(), texts)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = slack_packing.pack(docs.repartition(7), PATH).collect()
    check_rows(rows, {r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("length", [256])
def test_ids_come_with_the_pieces(spark, awkward, length):
    rows = slack_packing.pack(awkward, PATH, length=length, ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_empty_table(empty):
    assert slack_packing.pack(empty, PATH).collect() == []
