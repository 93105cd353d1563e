"""Packing documents into token sequences by minimum bin slack.

Tokens: the ids of each whole text by a given tokenizer, then an end id. A document's whole windows of
``length`` tokens are sequences of their own; what is left of it is a piece, as are the shorter documents.

A task tokenizes its documents and keeps the pieces of up to ``BUFFER_TOKENS`` tokens, by length. A window
begins with the longest piece; which multiset of the remaining lengths fills it closest to capacity is a
bounded subset-sum problem: the reachable sums are the bits of one integer, a length with
count c enters in steps of 1, 2, 4, .. copies (a shift and an or each), and the sums before each step, walked
backwards, give the counts. A multiset that fits is used for as many windows as its counts allow.

Where no multiset fills a window and no more pieces can be waited for, the longest remaining piece is cut to
fill it, so only a few documents are cut, and no window is short. At a task's end less than one window of
tokens is left; the ids of these go to fewer tasks, and so on, until one task has less than a window.
Its tokens become sequences of powers of two by the same choice, so nothing is padded.

Documents are not shuffled, and ids move only in what tasks leave. ``ids=True`` adds each piece's ids
(unsigned 32 bits, little-endian).

Defined cases: a null or empty text is its end id alone; repeated rows are packed one by one; a null doc_id
stays null. An empty table gives no pieces. Other columns of the input are not used.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep.llm.packing import encoder_of
from salesprep.llm.shared import raw_texts, slices, stage

LENGTH = 2048
END_ID = 1
#: Tokens and pieces that a task keeps before it fills windows.
BUFFER_TOKENS = 1 << 22
BUFFER_PIECES = 50_000
#: Sequence numbers: round, task, and a task's own number in its lowest bits.
TASK_BITS, OWN_BITS = 22, 36


class Piece(NamedTuple):
    doc: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray


def best_sum(counts: dict[int, int], lengths: list[int], room: int) -> Counter:
    """How many of each length (ascending ``lengths``, up to ``counts``) make up the largest sum up to ``room``."""
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[i]
        left, copies = min(counts[length], room // length), 1
        while left and not reach >> room:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= (reach << length * copies) & mask
            left -= copies
            copies *= 2
        if reach >> room:
            break
    taken, rest = Counter(), reach.bit_length() - 1
    for length, copies, before in reversed(steps):
        if not before >> rest & 1:
            taken[length] += copies
            rest -= length * copies
    return taken


class Stock:
    """Pieces by length, none longer than ``length``."""

    def __init__(self, length: int) -> None:
        self.length, self.tokens, self.n = length, 0, 0
        self.pieces: dict[int, list[Piece]] = defaultdict(list)
        self.counts: dict[int, int] = defaultdict(int)
        self.lengths: list[int] = []

    def add(self, piece: Piece) -> None:
        size = len(piece.ids)
        if not self.counts[size]:
            insort(self.lengths, size)
        self.pieces[size].append(piece)
        self.counts[size] += 1
        self.tokens += size
        self.n += 1

    def pop(self, size: int) -> Piece:
        self.counts[size] -= 1
        if not self.counts[size]:
            self.lengths.remove(size)
        self.tokens -= size
        self.n -= 1
        return self.pieces[size].pop()

    def choose(self, room: int) -> Counter:
        """Lengths that fill ``room`` as far as possible, the longest that fits among them."""
        fitting = bisect_right(self.lengths, room)
        if not fitting:
            return Counter()
        longest = self.lengths[fitting - 1]
        self.counts[longest] -= 1
        taken = best_sum(self.counts, self.lengths, room - longest)
        self.counts[longest] += 1
        taken[longest] += 1
        return taken

    def windows(self, room: int, cut: Callable[[], bool]) -> Iterator[list[Piece]]:
        """Full windows while there are tokens for them; one that needs a cut piece only if ``cut()``."""
        while self.tokens >= room:
            taken = self.choose(room)
            slack = room - sum(size * n for size, n in taken.items())
            if not slack:
                for _ in range(min(self.counts[size] // n for size, n in taken.items())):
                    yield [self.pop(size) for size, n in taken.items() for _ in range(n)]
            elif cut():
                window = [self.pop(size) for size, n in taken.items() for _ in range(n)]
                # what is left is longer than the slack, or more would have been taken
                long = self.pop(self.lengths[-1])
                self.add(long._replace(start=long.start + slack, ids=long.ids[slack:]))
                yield [*window, long._replace(ids=long.ids[:slack])]
            else:
                return


class Packer:
    """Sequences of one task, as rows; ``first`` is its first sequence number."""

    def __init__(self, length: int, first: int, with_ids: bool) -> None:
        self.stock, self.length, self.next, self.with_ids = Stock(length), length, first, with_ids
        self.rows: list[tuple] = []

    def put(self, window: list[Piece]) -> None:
        offset = 0
        for x in window:
            raw = x.ids.astype("<u4", copy=False).tobytes()
            self.rows.append((x.doc, x.start, len(x.ids), zlib.crc32(raw), x.doc_tokens, self.next, offset, raw if self.with_ids else None))
            offset += len(x.ids)
        self.next += 1

    def add(self, doc: int | None, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.length
        for s in range(0, whole, self.length):
            self.put([Piece(doc, start + s, doc_tokens, ids[s : s + self.length])])
        if whole < len(ids):
            # a copy, so that the ids of the whole windows can go
            self.stock.add(Piece(doc, start + whole, doc_tokens, ids[whole:].copy()))
        if self.stock.tokens >= BUFFER_TOKENS or self.stock.n >= BUFFER_PIECES:
            self.fill(lambda: self.stock.tokens > BUFFER_TOKENS // 2 or self.stock.n > BUFFER_PIECES // 2)

    def fill(self, cut: Callable[[], bool]) -> None:
        for window in self.stock.windows(self.length, cut):
            self.put(window)

    def close(self, last: bool) -> None:
        """Fill all windows; what is left becomes powers of two if this is the ``last`` task, else rows without a sequence."""
        self.fill(lambda: True)
        if last:
            for bit in range(self.stock.tokens.bit_length() - 1, -1, -1):
                if self.stock.tokens >= 1 << bit:
                    self.put(next(self.stock.windows(1 << bit, lambda: True)))
        for size in list(self.stock.lengths):
            for x in self.stock.pieces[size]:
                self.rows.append((x.doc, x.start, size, None, x.doc_tokens, None, None, x.ids.astype("<u4", copy=False).tobytes()))

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if f == "ids" else pa.int64()) for f, c in zip(FIELDS, columns, strict=True)], names=list(FIELDS))


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
SCHEMA = ", ".join(f"`{f}` {'binary' if f == 'ids' else 'long'}" for f in FIELDS)


def first_number(turn: int) -> int:
    return (turn << TASK_BITS | TaskContext.get().partitionId()) << OWN_BITS


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids) of every piece; ``length`` is a power of two."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(tokenizer), Packer(length, first_number(0), ids)
        for batch in slices(batches, 4 << 20):
            for doc, found in zip(batch["doc"].to_pylist(), encoder.encode(raw_texts(batch["t"])), strict=True):
                packer.add(doc, 0, len(found) + 1, np.append(found, np.uint32(end_id)))
            yield packer.batch()
        packer.close(last=False)
        yield packer.batch()

    def gather(turn: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = Packer(length, first_number(turn), ids)
            for batch in slices(batches, 4 << 20):
                for doc, start, doc_tokens, raw in zip(*(batch[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                    packer.add(doc, start, doc_tokens, np.frombuffer(raw, "<u4"))
                yield packer.batch()
            packer.close(last)
            yield packer.batch()

        return run

    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("t"))
    rows = stage(source.mapInArrow(tokenize, SCHEMA), "slack-pieces")
    done, turn = rows.where("sequence_id IS NOT NULL"), 0
    while True:
        left, turn = rows.where("sequence_id IS NULL"), turn + 1
        tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        tasks = max(1, -(-tokens // BUFFER_TOKENS))
        # neighbouring tasks' rests are read by one task, in an order that does not depend on the files
        dealt = left.coalesce(tasks).sortWithinPartitions("doc_id", "start", "length", "ids")
        rows = stage(dealt.mapInArrow(gather(turn, tasks == 1), SCHEMA), "slack-rest")
        done = done.unionByName(rows.where("sequence_id IS NOT NULL"))
        if tasks == 1:
            return done if ids else done.drop("ids")
