"""Packing documents into token sequences by bounded-space online best fit.

Tokens: the ids of each whole text by a given tokenizer, then an end id. Documents
of more than ``length`` tokens are cut into pieces of ``length``; the last piece may be
shorter. A full piece is a sequence of its own. The others are dealt out by hash
over tasks of about ``TASK_PIECES`` pieces. A task packs its pieces as they come (longest
first): each goes into the open bin with the least free space that holds it, found
in a bitset keyed by free space; without one a new bin opens, and when ``OPEN_BINS``
are open the fullest closes first. Bins that are still open at a task's end with
much space are packed once more, as items of their fill, by fewer tasks.

Only (row, piece, length) move between tasks, never tokens.

Defined cases: a null or empty text is its end id alone; repeated rows are packed one
by one; a null doc_id stays null. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from salesprep.llm.shared import kept, longs, raw_texts, slices, stage

LENGTH = 2048
END_ID = 0
#: A special token of the tokenizer; it separates words that are encoded together.
SEPARATOR = "<|endoftext|>"
OPEN_BINS = 4096
TASK_PIECES = 200_000
#: Words whose ids a task remembers; then it begins anew.
WORDS = 600_000
#: Words whose ids are put together at once.
CHUNK = 1 << 18
#: Lower-case letters that normalizing leaves as they are; a word of these alone is one piece for the tokenizer's model.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
PUNCTUATION = string.punctuation.encode()
ENDINGS = frozenset(bytes([c]) for c in PUNCTUATION)
LATIN = frozenset(chr(c).encode() for c in range(0xC0, 0x100) if chr(c).isalpha())
BYTE_LEVEL = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
#: How the byte-level step writes a space; it leaves a-z as they are.
SPACE = "\u0120"
#: New words that are encoded together.
GROUP = 1000


def before_ending(word: bytes) -> bytes:
    """A word without the punctuation after its last letter; the word itself if another sign is before it."""
    stem = word.rstrip(PUNCTUATION)
    return stem if stem[-1:].isalpha() or stem[-2:] in LATIN else word


class Encoder:
    """Ids of texts, word by word with a memory of words.

    The tokenizer must fold case, cut at white space whatever stands around it, and
    between letters and punctuation, and then write bytes as letters, as the public word
    tokenizer does. Then a text's ids are those of its space-separated words one after the other.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.sizes = np.zeros(1 << 12, np.int64)
        self.starts = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def learn(self, words: list[bytes]) -> None:
        """Remember words. Those of plain letters go to the tokenizer's model as they are, for nothing before it would change
        or cut them; the others are encoded as one text with a special token between them."""
        ascii_letters, letters, others = [], [], []
        for w in words:
            (ascii_letters if w.isalpha() and w.islower() else letters if LETTERS.fullmatch(w) else others).append(w)
        for group in (ascii_letters[i : i + GROUP] for i in range(0, len(ascii_letters), GROUP)):
            self.learn_letters(group, b" ".join(group).decode().split(" "))
        for group in (letters[i : i + GROUP] for i in range(0, len(letters), GROUP)):
            ((written, _),) = BYTE_LEVEL.pre_tokenize_str(b" ".join(group).decode())
            self.learn_letters(group, written.split(SPACE))
        between = SEPARATOR.encode()
        plain = [w for w in others if between not in w]
        groups = [plain[i : i + GROUP] for i in range(0, len(plain), GROUP)]
        for group in [*groups, *([w] for w in others if between in w)]:
            found = self.tokenizer.encode_batch_fast([between.join(group).decode()], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            inner = np.flatnonzero(ids == self.separator) if len(group) > 1 else np.zeros(0, np.int64)
            starts = np.append(0, inner + 1)
            self.store(group, ids, starts, np.append(inner, len(ids)) - starts)

    def learn_letters(self, words: list[bytes], written: list[str]) -> None:
        """Remember words that the byte-level step writes as ``written``."""
        found = list(map(self.model.tokenize, written))
        sizes = np.fromiter(map(len, found), np.int64, len(words))
        ids = np.fromiter((token.id for tokens in found for token in tokens), np.uint32, sizes.sum())
        self.store(words, ids, np.cumsum(sizes) - sizes, sizes)

    def store(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        place = len(self.places)
        self.sizes, self.starts = grown(self.sizes, place + len(words)), grown(self.starts, place + len(words))
        self.flat = grown(self.flat, self.used + len(ids))
        self.sizes[place : place + len(words)] = sizes
        self.starts[place : place + len(words)] = starts + self.used
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.places.update(zip(words, range(place, place + len(words)), strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        column = pa.array(texts, pa.binary()).cast(pa.string())
        # the tokenizer folds case, but not within its special tokens
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column)))
        # each word is looked up once, however often these texts have it; around outer white space there are empty words, without ids
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.binary())
        numbers, bounds = coded.indices.to_numpy(), split.offsets.to_numpy()
        del column, split, coded
        places = self.prepare(words)
        ends = np.append(0, np.cumsum(self.sizes[places][numbers]))
        ids = np.empty(ends[-1], np.uint32)
        for i in range(0, len(numbers), CHUNK):
            some = numbers[i : i + CHUNK]
            ids[ends[i] : ends[i + len(some)]] = self.gather(places[some])
        for first, last in pairwise(ends[bounds].tolist()):
            yield ids[first:last]

    def prepare(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words; the new ones are learnt at once.

        Punctuation after a letter is a piece of its own, so such words are put together from what is before it and from it.
        """
        if len(self.places) > WORDS:
            self.forget()
        found = words.to_numpy(zero_copy_only=False)
        places = np.fromiter(map(self.places.get, found, repeat(-1)), np.int64, len(found))
        missing = np.flatnonzero(places < 0)
        new = found[missing].tolist()
        cut = [(w, stem) for w in new if w[-1:] in ENDINGS and (stem := before_ending(w)) != w and b"<|" not in w]
        whole = set(new).difference([w for w, _ in cut])
        parts = [part for w, stem in cut for part in (stem, w[len(stem) :])]
        self.learn([*whole, *set(parts).difference(self.places).difference(whole)])
        if cut:
            at = self.look_up(parts)
            sizes = self.sizes[at].reshape(-1, 2).sum(axis=1)
            self.store([w for w, _ in cut], self.gather(at), np.cumsum(sizes) - sizes, sizes)
        places[missing] = self.look_up(new)
        return places

    def look_up(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def gather(self, at: np.ndarray) -> np.ndarray:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        index = np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.flat[index]


def grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.resize(array, max(size, 2 * len(array)))


def encoder_of(path: str) -> Encoder:
    """The worker process's encoder; it keeps its words from task to task."""
    return kept(f"encoder {path}", lambda: Encoder(path))


class Bins:
    """Open bins by free space, at most ``most``; ``put`` gives the bin and the place in it."""

    def __init__(self, length: int, most: int) -> None:
        self.length, self.most = length, most
        self.bits = 0
        self.open: list[list[int]] = [[] for _ in range(length + 1)]
        self.n_open = self.made = 0

    def put(self, size: int) -> tuple[int, int]:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self.take(free)
        else:
            if self.n_open == self.most:
                self.take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.length, self.made
            self.made += 1
        if left := free - size:
            self.open[left].append(number)
            self.bits |= 1 << left
            self.n_open += 1
        return number, self.length - free

    def take(self, free: int) -> int:
        number = self.open[free].pop()
        if not self.open[free]:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number


def cut(docs: DataFrame, tokenizer: str, length: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces: doc, piece, start, length, crc of each row; ``row`` tells equal rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in slices(batches, 4 << 20):
            out: list[tuple] = []
            owners: list[int] = []
            for i, found in enumerate(encoder.encode(raw_texts(batch["t"]))):
                ids = np.append(found, np.uint32(END_ID)).astype("<u4")
                for k, s in enumerate(range(0, len(ids), length)):
                    part = ids[s : s + length]
                    out.append((k, s, len(part), zlib.crc32(part.tobytes())))
                    owners.append(i)
            piece, start, size, crc = np.array(out, np.int64).reshape(-1, 4).T
            taken = batch.select(["doc", "row"]).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(piece, pa.int32()), longs(start), longs(size), longs(crc)], names=["doc", "row", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "doc long, row long, piece int, start long, length long, ids_crc32 long")


def packer(length: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs the sizes (column length) that come into bins of this task; bin numbers are unique over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        bins = Bins(length, most)
        for batch in batches:
            placed = [bins.put(n) for n in batch["length"].to_pylist()]
            found = np.array(placed, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch["row"], batch["piece"], batch["length"], longs(found[:, 0] + first), longs(found[:, 1])], names=["row", "piece", "length", "bin", "place"])

    return run


def dealt(items: DataFrame, tasks: int) -> DataFrame:
    """Items over tasks by hash, longest first, in an order that does not depend on where they came from."""
    return items.repartition(tasks, F.xxhash64("row", "piece")).sortWithinPartitions(F.desc("length"), "row", "piece")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", task_pieces: int = TASK_PIECES, open_bins: int = OPEN_BINS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = stage(cut(docs, tokenizer, length, doc_id, text), "packing-pieces")
    part = pieces.where(F.col("length") < length).select("row", "piece", "length")
    whole = pieces.where(F.col("length") == length)
    tasks = max(1, -(-part.count() // task_pieces))
    schema = "row long, piece int, length long, bin long, place long"
    first = stage(dealt(part, tasks).mapInArrow(packer(length, open_bins), schema), "packing-first")
    # what is left open is packed again, a bin of the first pass being one item
    fill = first.groupBy("bin").agg(F.sum("length").alias("fill")).where(F.col("fill") < length)
    again = fill.select(F.col("bin").alias("row"), F.lit(0).alias("piece"), F.col("fill").alias("length"))
    tasks = max(1, -(-again.count() // task_pieces))
    second = dealt(again, tasks).mapInArrow(packer(length, open_bins), schema)
    second = stage(second.select(F.col("row").alias("bin"), F.col("bin").alias("outer"), F.col("place").alias("shift")), "packing-second")
    moved = first.join(second, "bin", "left").select("row", "piece", F.when(F.col("outer").isNull(), F.col("bin") * 4).otherwise(F.col("outer") * 4 + 1).alias("sequence_id"), (F.col("place") + F.coalesce("shift", F.lit(0))).alias("offset"))
    columns = [F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    short = pieces.where(F.col("length") < length).join(moved, ["row", "piece"]).select(*columns)
    alone = whole.select("*", (F.monotonically_increasing_id() * 4 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).select(*columns)
    return short.unionByName(alone)
