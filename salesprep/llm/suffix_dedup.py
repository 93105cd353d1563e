"""Removal of repeated passages by induced suffix sorting.

A byte is removed if a string of ``LENGTH`` bytes that covers it starts anywhere else
too, in any text or in the same. Texts are UTF-8 bytes; matches never cross texts.

Where to look. Every window of ``LENGTH`` bytes has grams of two fifths of its length; the gram with
the smallest hash is its anchor. Equal windows have equal anchors at equal places, so a
window can be repeated only if its anchor's hash occurs twice. Spark counts the
anchors' hashes and joins the repeated ones to the texts; around each repeated
anchor a suffix tuple is cut: the ``LENGTH`` bytes from the anchor on (its right) and the bytes
before it, as many as a window can have there (its left). Tuples are shuffled by hash, and every
window that is repeated meets its copy in one shard.

Inside a shard. Spark's external sort orders the tuples by hash and right bytes: the order of the
sampled suffixes, with common prefixes of neighbours found by comparing them. From
it the order of the suffixes that begin one byte further left is induced, and so
on recursively, for all places of the window before the anchor: a tuple is pushed
with its class and preceding byte into a priority queue, and popped in order of
both; the common prefix of new neighbours is the minimum over the tuples
between them. A window that begins l bytes before the anchor is repeated where a
neighbour of the same class has a common prefix of ``LENGTH`` - l or more. Queues keep
``MEMORY_TUPLES`` tuples in memory and the rest in sorted runs on the task's disk;
a hash with more tuples than that has its bytes in mapped files there. The files
go with the task.

Tuples that are copies of each other are combined before the shuffle, so that a hot hash
brings a task only its distinct surroundings.

Exact copies of a text count once; being repeated, they are removed whole. Whole texts
are never shuffled: they are shelved once, and the places of repeated anchors, and later the
spans to remove, come to them.

What is compared is a ``Unit``: bytes, or words (what white space separates). For words a text is
turned into a string of codes of 8 bytes, 64-bit hashes, one for each word; anchors and windows begin only at whole codes, so a
window of 51 words is judged like any string of 408 bytes, however long its words are in the text. The
white space between removed words goes with them.

Defined cases: a null or empty text has no bytes and is kept as empty; texts shorter
than a window stay whole; a null doc_id stays null; repeated rows are copies; of an empty table nothing is
left. Where text is returned after bytes were removed, bytes of a character that was cut in two are left out.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep.llm.shared import longs, met, raw_texts, shelve, slices, stage
from salesprep.operators.lookup import join_lookup
from salesprep.staging import scope, stage_measured

LENGTH = 400
#: Bytes of the code of a word.
CODE = 8
MEMORY_TUPLES = 1 << 20
#: Tuples of small hashes that are sorted together.
SHARD_TUPLES = 8_000
#: Tuples that a task remembers to combine copies; then it begins anew.
COMBINED = 200_000
#: Bytes of a text that are hashed at once.
PART = 1 << 18
TID = 16

_random = np.random.default_rng(20_240)
BYTE_HASHES = _random.integers(0, 1 << 64, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@dataclass(frozen=True)
class Unit:
    """Windows of ``count`` bytes, or of ``count`` words; sizes below are those of the compared strings, in bytes."""

    count: int = LENGTH
    words: bool = False

    @property
    def step(self) -> int:
        return CODE if self.words else 1

    @property
    def length(self) -> int:
        return self.count * self.step

    @property
    def gram(self) -> int:
        """Grams have two fifths of a window: 160 of 400 bytes."""
        return 2 * self.count // 5 * self.step

    @property
    def left(self) -> int:
        return self.length - self.gram

    def string(self, text: bytes) -> bytes:
        """What is compared in place of a text."""
        return codes(text) if self.words else text

    def spans(self, text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Spans of the compared string as spans of the text."""
        if not self.words:
            return spans
        starts, ends = word_places(text)
        return [(int(starts[a // CODE]), int(ends[b // CODE - 1])) for a, b in spans]


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    raw = np.frombuffer(text, np.uint8)
    solid = np.concatenate([[False], (raw != 32) & ((raw < 9) | (raw > 13)), [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def codes(text: bytes) -> bytes:
    """Hashes of the words of a text, one after the other; worked out in parts of about ``PART`` bytes."""
    starts, ends = word_places(text)
    raw, found, k = np.frombuffer(text, np.uint8), [], 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + PART, side="right")))
        first = int(starts[k])
        part = raw[first : ends[stop - 1]]
        powers = np.cumprod(np.append(np.uint64(1), np.full(len(part), BASE)))
        sums = np.append(np.uint64(0), np.cumsum(BYTE_HASHES[part] * powers[:-1]))
        back = np.cumprod(np.append(np.uint64(1), np.full(len(part), INVERSE)))
        a, b = starts[k:stop] - first, ends[k:stop] - first
        found.append(mixed((sums[b] - sums[a]) * back[a]))
        k = stop
    return b"".join(x.tobytes() for x in found)


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of each run of ``width`` values."""
    best = np.minimum if least else np.maximum
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max if least else 0, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(text: bytes, unit: Unit = Unit()) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows of a string."""
    places, hashes = [], []
    raw = np.frombuffer(text, np.uint8)
    length, gram, step = unit.length, unit.gram, unit.step
    width = (length - gram) // step + 1
    for start in range(0, max(len(raw) - length + 1, 0), PART):
        part = raw[start : start + PART + length - step]
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(part) - 1, BASE)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_HASHES[part] * powers)])
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(part) - gram, INVERSE)]))
        grams = mixed(((sums[gram:] - sums[:-gram]) * back)[::step])
        least = sliding(grams, width, True)
        # a gram is an anchor if it is the least of some window: if the largest of the minima of its windows is its own
        edges = np.zeros(width - 1, np.uint64)
        found = np.flatnonzero(sliding(np.concatenate([edges, least, edges]), width, False) == grams)
        places.append(found * step + start)
        hashes.append(grams[found])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first].view(np.int64)


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def measure(batches: Iterator[pa.RecordBatch], unit: Unit = Unit()) -> Iterator[pa.RecordBatch]:
    """Digest, sizes and anchors of each text; ``size`` is that of the compared string."""
    for batch in slices(batches):
        texts = raw_texts(batch["t"])
        shas = [digest(t) for t in texts]
        strings = [unit.string(t) for t in texts]
        found = [anchors(t, unit) for t in strings]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc"],
                batch["row"],
                pa.array([s[:TID] for s in shas], pa.binary()),
                longs(np.array([len(t) for t in texts], np.int64)),
                longs(np.array([len(t) for t in strings], np.int64)),
                pa.array([s.hex() for s in shas], pa.string()),
                pa.array([p for p, _ in found], pa.list_(pa.int64())),
                pa.array([h for _, h in found], pa.list_(pa.int64())),
            ],
            names=["doc", "row", "tid", "n_bytes", "size", "sha256", "places", "hashes"],
        )


MEASURED = "doc long, row long, tid binary, n_bytes long, size long, sha256 string, places array<long>, hashes array<long>"


def cut(batches: Iterator[pa.RecordBatch], unit: Unit = Unit()) -> Iterator[pa.RecordBatch]:
    """Suffix tuples: hash, how many share it, row of the text, place, bytes before (nearest first) and from there on.

    Combined before the shuffle: of tuples with equal hash and bytes a task sends one.
    As they are copies, all their windows are repeated, so each gives its span at once, in
    rows with ``n`` 0 that hold its bounds as ``place`` and ``end`` and are dealt out by text.
    """
    seen: dict[bytes, tuple[int, int, int] | None] = {}
    for batch in slices(batches, 1 << 20):
        out = []

        def covered(row: int, first: int, end: int, out: list = out) -> None:
            out.append((row, 0, row, first, end, b"", b""))

        for row, found, text in zip(batch["row"].to_pylist(), batch["found"].to_pylist(), batch["raw"].to_pylist(), strict=True):
            spans, raw = [], unit.string(text)
            for x in found:
                p = x["place"]
                first, end = max(0, p - unit.left), min(len(raw), p + unit.length)
                key = hashlib.blake2b(b"%d %d " % (x["h"], p - first) + raw[first:end], digest_size=TID).digest()
                if key not in seen:
                    seen[key] = (row, first, end)
                    out.append((x["h"], x["n"], row, p, 0, raw[first:p][::-1], raw[p:end]))
                    continue
                if seen[key] is not None:
                    covered(*seen[key])
                    seen[key] = None
                spans.append({"first": first, "end": end})
            for first, end in merged(spans):
                covered(row, first, end)
        if len(seen) > COMBINED:
            seen.clear()
        columns = list(zip(*out, strict=True)) or [()] * 7
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["h", "n", "row", "place", "end", "before", "after"])


TUPLES = "h long, n long, row long, place long, end long, before binary, after binary"


class TupleQueue:
    """Priority queue of suffix tuples, columns (key, number, common prefix, occurrence), by key and number.

    It holds ``most`` tuples in memory; beyond, they are written as sorted runs, which
    are merged in blocks when they are drained.
    """

    def __init__(self, most: int) -> None:
        self.most, self.held, self.n, self.runs = most, [], 0, []

    def push(self, tuples: np.ndarray) -> None:
        self.held.append(tuples)
        self.n += tuples.shape[1]
        if self.n > self.most:
            self.spill()

    def ordered(self) -> np.ndarray:
        tuples = np.concatenate(self.held, axis=1) if self.held else np.zeros((4, 0), np.int64)
        self.held, self.n = [], 0
        if (tuples[0, 1:] < tuples[0, :-1]).any():
            tuples = tuples[:, np.lexsort((tuples[1], tuples[0]))]
        return tuples

    def spill(self) -> None:
        run = tempfile.TemporaryFile()
        np.ascontiguousarray(self.ordered().T).tofile(run)
        run.seek(0)
        self.runs.append(run)

    def drain(self) -> Iterator[np.ndarray]:
        if not self.runs:
            yield self.ordered()
            return
        self.spill()
        block = max(1, self.most // (2 * len(self.runs)))
        read = lambda run: np.fromfile(run, np.int64, 4 * block).reshape(-1, 4).T
        heads = [read(run) for run in self.runs]
        while any(h.shape[1] for h in heads):
            # up to the least of the runs' last tuples everything is here
            key, number = min((int(h[0, -1]), int(h[1, -1])) for h in heads if h.shape[1])
            ready = []
            for i, h in enumerate(heads):
                n = int(((h[0] < key) | ((h[0] == key) & (h[1] <= number))).sum())
                ready.append(h[:, :n])
                heads[i] = h[:, n:] if n < h.shape[1] else read(self.runs[i])
            merged = np.concatenate(ready, axis=1)
            yield merged[:, np.lexsort((merged[1], merged[0]))]
        for run in self.runs:
            run.close()


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of ``values[first..last]``."""
    if not len(first):
        return values[:0]
    bounds = np.column_stack([first, last + 1]).ravel()
    return np.minimum.reduceat(np.append(values, 0), bounds)[::2]


class Induction:
    """Orders of the suffixes 0, 1, 2, .. bytes before the anchors, from the order at the anchors.

    ``before`` holds the preceding bytes of each occurrence (a row each), ``sizes`` how
    many there are. ``mark(level, occurrences)`` is called for the repeated windows.
    """

    def __init__(self, before: np.ndarray, sizes: np.ndarray, most: int, mark: Callable[[int, np.ndarray], None], unit: Unit = Unit()) -> None:
        self.before, self.sizes, self.most, self.mark = before, sizes, most, mark
        self.length, self.left, self.step = unit.length, unit.left, unit.step

    def run(self, queue: TupleQueue) -> None:
        for level in range(self.left + 1):
            queue, pushed = self.level(queue, level)
            if not pushed:
                return

    def level(self, queue: TupleQueue, level: int) -> tuple[TupleQueue, int]:
        after, pushed = TupleQueue(self.most), 0
        last_key, last_occurrence, last_class = -1, -1, 0
        open_minima = np.full(256, -1, np.int64)  # of the class that goes on: least prefix since a byte was seen
        for tuples in queue.drain():
            if not tuples.shape[1]:
                continue
            key, _, prefix, occurrence = tuples
            new = np.empty(len(key), bool)
            new[0] = key[0] != last_key
            new[1:] = key[1:] != key[:-1]
            prefix = np.where(new, 0, prefix)
            hit = prefix >= self.length - level
            if level % self.step == 0 and hit.any():
                before = np.concatenate([[last_occurrence], occurrence[:-1]])
                self.mark(level, np.unique(np.concatenate([occurrence[hit], before[hit]])))
            classes = last_class + np.cumsum(new)
            single = new.copy()
            single[:-1] &= new[1:]
            single[-1] = False  # it may go on in the next block
            going = np.flatnonzero(~single & (self.sizes[occurrence] > level)) if level < self.left else np.zeros(0, np.int64)
            byte = self.before[occurrence[going], min(level, self.left - 1)].astype(np.int64)
            keys = (classes[going] << 8) | byte
            carried = np.zeros(len(going), np.int64)
            order = np.argsort(keys, kind="stable") if (keys[1:] < keys[:-1]).any() else np.arange(len(keys))
            places = going[order]
            same = np.flatnonzero(keys[order][1:] == keys[order][:-1])
            carried[order[same + 1]] = range_minima(prefix, places[same] + 1, places[same + 1])
            goes_on = not new[0]
            first_end = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(key)
            if goes_on:
                is_first = np.ones(len(order), bool)
                is_first[same + 1] = False
                firsts = order[is_first & (places < first_end)]
                known = firsts[open_minima[byte[firsts]] >= 0]
                least = np.minimum.accumulate(prefix[:first_end])
                carried[known] = np.minimum(open_minima[byte[known]], least[going[known]])
            # what the block's last class hands on
            tail = len(key) - int(np.argmax(new[::-1])) - 1 if new.any() else 0
            if goes_on and tail == 0:
                open_minima = np.where(open_minima >= 0, np.minimum(open_minima, prefix.min()), -1)
            else:
                open_minima = np.full(256, -1, np.int64)
            to_end = np.minimum.accumulate(np.append(self.length, prefix[:tail:-1] if tail else prefix[:0:-1]))[::-1]
            inside = going >= tail
            open_minima[byte[inside]] = to_end[going[inside] - tail]
            if len(going):
                after.push(np.stack([keys, pushed + np.arange(len(going)), carried, occurrence[going]]))
                pushed += len(going)
            last_key, last_occurrence, last_class = int(key[-1]), int(occurrence[-1]), int(classes[-1])
        return after, pushed


class Runs:
    """Collects, per occurrence, runs of levels at which its window is repeated."""

    def __init__(self, n: int, step: int = 1) -> None:
        self.step = step
        self.since = np.full(n, -1, np.int16)
        self.last = np.full(n, -1, np.int16)
        self.done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def mark(self, level: int, occurrences: np.ndarray) -> None:
        fresh = occurrences[self.last[occurrences] != level - self.step] if level else occurrences
        ended = fresh[self.last[fresh] >= 0]
        self.done.append((ended, self.since[ended], self.last[ended]))
        self.since[fresh] = level
        self.last[occurrences] = level

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ended = np.flatnonzero(self.last >= 0)
        self.done.append((ended, self.since[ended], self.last[ended]))
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*self.done, strict=True))


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    values = column.to_pylist()
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(-1, width), sizes


class Shard:
    """Tuples of one or more hashes, in order of hash and following bytes; ``rows`` is their number if they are too many for memory."""

    def __init__(self, most: int, rows: int = 0, unit: Unit = Unit()) -> None:
        self.unit, self.length, self.left = unit, unit.length, unit.left
        self.most, self.n, self.queue = most, 0, TupleQueue(most)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.files = None
        if rows > most:
            self.folder = tempfile.TemporaryDirectory()
            mapped = lambda name, kind, shape: np.memmap(f"{self.folder.name}/{name}", kind, "w+", shape=shape)
            self.files = (mapped("before", np.uint8, (rows, self.left)), mapped("sizes", np.int64, (rows,)), mapped("place", np.int64, (rows,)), mapped("row", np.int64, (rows,)))
        self.last: tuple[np.ndarray, int, int] | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        after, sizes = matrix(batch["after"], self.length)
        before, before_sizes = matrix(batch["before"], self.left)
        h = batch["h"].to_numpy()
        if self.last is None:
            self.last = (after[0], int(sizes[0]), int(h[0]) ^ 1)
        above = np.concatenate([self.last[0][None], after[:-1]])
        differ = above != after
        prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), self.length)
        prefix = np.minimum(prefix, np.minimum(sizes, np.append(self.last[1], sizes[:-1])))
        # a key is the hash's place in the order, so that the queue keeps the order it is given
        self.key = getattr(self, "key", 0) + np.cumsum(np.append(self.last[2], h[:-1]) != h)
        number = np.arange(self.n, self.n + len(h))
        self.queue.push(np.stack([self.key << 8, number, prefix, number]))
        self.key = int(self.key[-1])
        self.last = (after[-1], int(sizes[-1]), int(h[-1]))
        part = (before, before_sizes, batch["place"].to_numpy(), batch["row"].to_numpy())
        if self.files:
            for file, values in zip(self.files, part, strict=True):
                file[self.n : self.n + len(h)] = values
        else:
            self.parts.append(part)
        self.n += len(h)

    def spans(self) -> Iterator[pa.RecordBatch]:
        """row, first and end of the repeated passages around each occurrence."""
        before, sizes, place, row = self.files or (np.concatenate(x) for x in zip(*self.parts, strict=True))
        runs = Runs(self.n, self.unit.step)
        Induction(before, sizes, self.most, runs.mark, self.unit).run(self.queue)
        occurrence, since, last = runs.all()
        for i in range(0, len(occurrence), 10_000):
            o, s, e = (x[i : i + 10_000] for x in (occurrence, since, last))
            yield pa.RecordBatch.from_arrays([longs(row[o]), longs(place[o] - e), longs(place[o] - s + self.length)], names=["row", "first", "end"])
        if self.files:
            self.files = None
            self.folder.cleanup()


def induced(most: int = MEMORY_TUPLES, together: int = SHARD_TUPLES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of repeated bytes, of tuples that come in order of hash and following bytes."""

    def run(batches: Iterator[pa.RecordBatch], unit: Unit = Unit()) -> Iterator[pa.RecordBatch]:
        shard, last = None, None
        for batch in slices(batches):
            direct = np.array(batch["n"].to_numpy() == 0)
            if direct.any():
                spans = batch.filter(pa.array(direct))
                yield pa.RecordBatch.from_arrays([spans["row"], spans["place"], spans["end"]], names=["row", "first", "end"])
                batch = batch.filter(pa.array(~direct))
                if not batch.num_rows:
                    continue
            h, n = batch["h"].to_numpy(), batch["n"].to_numpy()
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            first = 0
            for s in starts.tolist():
                if h[s] == last:
                    continue
                # between two hashes a shard that is full ends, and a hash too large for memory stands alone
                waiting = (shard.n if shard else 0) + s - first
                if waiting and (waiting >= together or n[s] > most or (shard and shard.files)):
                    if s > first:
                        shard = shard or Shard(most, int(n[first]), unit)
                        shard.add(batch.slice(first, s - first))
                    yield from shard.spans()
                    shard, first = None, s
            if batch.num_rows > first:
                shard = shard or Shard(most, int(n[first]), unit)
                shard.add(batch.slice(first))
            last = h[-1] if len(h) else last
        if shard:
            yield from shard.spans()

    return run


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for x in sorted((s["first"], s["end"]) for s in spans):
        if out and x[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x[1])
        else:
            out.append(list(x))
    return [tuple(x) for x in out]


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for run in runs for e in run), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How much is removed of each text with repeated passages, and the digest of the rest."""
    for batch in slices(batches):
        runs = [merged(s) for s in batch["spans"].to_pylist()]
        kept = [digest(kept_bytes(raw, r)).hex() for raw, r in zip(raw_texts(batch["raw"]), runs, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], longs(np.array([sum(b - a for a, b in r) for r in runs], np.int64)), longs(np.array([len(r) for r in runs], np.int64)), pa.array(kept, pa.string())],
            names=["row", "n_removed", "n_spans", "kept_sha256"],
        )


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: Unit = Unit()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shelved ``docs``; their texts (a row each: doc, row, n_bytes, sha256); row and spans of those with repeated passages."""
    spark = docs.sparkSession
    with scope(spark) as run:
        shelf = shelve(docs, "suffix-shelf")
        raw = F.col(f"c{docs.columns.index(text)}")
        source = shelf.select(F.col(f"c{docs.columns.index(doc_id)}").cast("long").alias("doc"), "row", raw.alias("t"))
        texts = stage(source.mapInArrow(lambda batches: measure(batches, unit), MEASURED), "suffix-texts")
        long_texts = texts.where(F.col("size") >= unit.length)
        firsts = long_texts.groupBy("tid").agg(F.min("row").alias("first"), F.count("*").alias("copies")).where("copies > 1")
        copied, size = stage_measured(long_texts.select("row", "tid", F.col("size").alias("end")).join(firsts, "tid").select("row", "first", "end"), "suffix-copied")
        once = join_lookup(long_texts.select("row", "places", "hashes"), copied.where("row <> first").select("row"), ["row"], "left_anti", size=size)
        found = once.select("row", F.explode(F.arrays_zip("places", "hashes")).alias("x")).select("row", F.col("x.places").alias("place"), F.col("x.hashes").alias("h"))
        often = stage(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "suffix-often")
        wanted = found.join(often, "h").groupBy("row").agg(F.collect_list(F.struct("place", "h", "n")).alias("found"))
        tuples = met(shelf, stage(wanted, "suffix-wanted"), "inner").select("row", "found", raw.cast("binary").alias("raw")).mapInArrow(lambda batches: cut(batches, unit), TUPLES)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = tuples.repartition(tasks, "h").sortWithinPartitions("h", "after")
        shards = induced()
        spans = dealt.mapInArrow(lambda batches: shards(batches, unit), "row long, first long, end long")
        whole = copied.select("row", F.lit(0).cast("long").alias("first"), "end")
        spans = stage(spans.unionByName(whole).groupBy("row").agg(F.collect_set(F.struct("first", "end")).alias("spans")), "suffix-spans")
        rows = stage(texts.select("doc", "row", "n_bytes", "sha256"), "suffix-rows")
        run.keep(shelf, rows, spans)
    return shelf, rows, spans


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; n_kept bytes are left."""
    shelf, texts, spans = repeats(docs, doc_id, text)
    changed = met(shelf, spans, "inner").select("row", "spans", F.col(f"c{docs.columns.index(text)}").alias("raw"))
    left = changed.mapInArrow(removal, "row long, n_removed long, n_spans long, kept_sha256 string")
    removed = F.coalesce("n_removed", F.lit(0)).cast("long")
    return texts.join(left, "row", "left").select(
        F.col("doc").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        (F.col("n_bytes") - removed).alias("n_kept"),
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: Unit = Unit()) -> DataFrame:
    """``docs`` with what is left of each text; null texts stay null. Texts that lose all their bytes become empty."""
    shelf, _, spans = repeats(docs, doc_id, text, unit)
    place = docs.columns.index(text)
    names = [f"c{i}" for i in range(len(docs.columns))]

    def rest(raw: bytes, found: list[dict]) -> str:
        return kept_bytes(raw, unit.spans(raw, merged(found))).decode(errors="ignore")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = list(batch.columns[:-1])
            found = batch["spans"].to_pylist()
            left = [t if s is None else rest(t.encode(), s) for t, s in zip(out[place].to_pylist(), found, strict=True)]
            out[place] = pa.array(left, out[place].type)
            yield pa.RecordBatch.from_arrays(out, names=names)

    kept = met(shelf, spans, "left").select(*names, "spans").mapInArrow(remove, shelf.select(*names).schema)
    return kept.toDF(*docs.columns)
