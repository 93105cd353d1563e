import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from salesprep.llm import packing
from salesprep.llm.queries import QUERIES, word_tokenizer


def check(found, source, length):
    """Pieces against the tokenizer alone, and sequences without gaps or overflow; returns (sequences, least possible)."""
    tokenizer = Tokenizer.from_file(word_tokenizer())
    want, total = defaultdict(int), 0
    for doc, text in source:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for k, s in enumerate(range(0, len(ids), length)):
            want[(doc, k, s, len(ids[s : s + length]), zlib.crc32(ids[s : s + length].tobytes()))] += 1
    rows, sequences = found.collect(), defaultdict(list)
    for r in rows:
        want[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] -= 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences), -(-total // length)


def test_query_packs_to_the_bound(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    used, least = check(QUERIES["op5_best_fit_packing"](spark, sf), docs, 2048)
    assert used <= least + 1


def test_awkward_and_empty(spark, awkward, empty):
    source = awkward.select("doc_id", "text").collect()
    used, least = check(packing.pack(awkward, word_tokenizer(), length=64), source, 64)
    assert used <= 1.02 * least + 1
    used, least = check(packing.pack(awkward, word_tokenizer(), length=64, task_pieces=3, open_bins=2), source, 64)
    assert used <= 1.5 * least
    assert packing.pack(empty, word_tokenizer()).count() == 0


def test_encoder_equals_tokenizer_on_odd_strings(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 500)
    encoder, rng = packing.Encoder(word_tokenizer()), random.Random(3)
    signs = [chr(c) for c in range(0x180)] + list("́̇   ​﻿İΣ日") + ["a.", "b,", "'st", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "\n"]
    for _ in range(300):
        texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(10)]
        want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == want


def test_words_of_letters_and_their_endings_skip_the_whole_tokenizer():
    class Watched:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.seen += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    encoder = packing.Encoder(word_tokenizer())
    encoder.tokenizer = watched = Watched(encoder.tokenizer)
    text = "Plain wörds, élan?! straße.*** and 12 o'clock ×,× naïve&&& É### ñ'$"
    want = watched.tokenizer.encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in encoder.encode([text.encode()])] == [want]
    seen = set(" ".join(watched.seen).replace(packing.SEPARATOR, " ").split())
    assert seen == {",", "?!", ".***", "12", "o'clock", "×,×", "&&&", "É", "###", "'$"}


def test_a_word_is_looked_up_once_however_often_the_texts_have_it():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

        def get(self, word, other=None):
            self.asked += 1
            return super().get(word, other)

    encoder = packing.Encoder(word_tokenizer())
    encoder.places = Counted()
    texts = ["Two words, two WORDS\t" * 500, "", " \n", " two\x0b"]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == want
    assert encoder.places.asked < 50
    assert list(encoder.encode([])) == []


def test_best_fit_takes_the_fullest_bin_that_holds_and_closes_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.put(n) for n in (6, 8, 2, 4)] == [(0, 0), (1, 0), (1, 8), (0, 6)]
    bins = packing.Bins(10, 2)
    # the third bin closes the one filled to 8, so the 2 goes elsewhere
    assert [bins.put(n) for n in (8, 7, 9, 2)][2:] == [(2, 0), (1, 7)]
