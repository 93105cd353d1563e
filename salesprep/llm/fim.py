"""Fill-in-the-middle transformation, with a learned rank index over the places where a text may be cut.

Units of a text: a run of characters other than white space (space, 9 to 13) with the white space before it; white
space at the end is a unit of its own. A text of n units may be cut at n + 1 boundaries. Their byte
offsets are learnt by a piecewise linear function of the rank: segments are fitted greedily, each as
long as one line stays within ``ERROR`` bytes of all its offsets (the cone of slopes that do so is
narrowed offset by offset), and what a line misses is stored as one signed byte for each rank. A cut
looks up its segment, predicts the offset in whole numbers and adds the stored residual, so it is
exact; the index takes about a byte a unit, an eighth of the plain offsets.

Cuts and form follow from a hash of seed and document id, so a run can be repeated. ``transform``
returns the outputs themselves; ``restored`` gives back the text from an output and its form alone.

Defined cases: a null or empty text has no units, is ``plain`` and its output is empty; a text that
holds one of the marks is ``plain``, so every other output can be taken apart; a null doc_id is
hashed as an empty string; repeated rows are transformed one by one, rows of equal id alike. An empty
table gives no rows. Texts are worked on whole; other columns of the input are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesprep.llm.shared import raw_texts, slices

SEED = 42
#: Percentage of texts that are cut, and of those the percentage with the suffix first.
CUT, SUFFIX_FIRST = 50, 80
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes by which a line may miss an offset; rounding adds two, and a residual is a signed byte.
ERROR = 125
#: Slopes are whole numbers of 2 ** -FRACTION bytes; a segment's ranks are bounded, so rounding moves an offset by a byte at most.
FRACTION = 20
SEGMENT = 1 << FRACTION
#: Offsets that are first tried for a segment; twice as many each time it goes on.
STRIDE = 256


@dataclass(frozen=True)
class RankIndex:
    """Segments (first rank, its offset, slope) and a residual for each rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[at] + ((self.slope[at] * (ranks - self.first[at])) >> FRACTION)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of the boundaries of these ranks."""
        return self.predict(ranks) + self.residuals[ranks]


def segment(offsets: np.ndarray, start: int) -> tuple[int, int]:
    """End and slope of the longest segment from ``start`` on that one line keeps within ``ERROR``."""
    low, high, end, stride = -np.inf, np.inf, start + 1, STRIDE
    last = min(len(offsets), start + SEGMENT)
    while end < last:
        steps = np.arange(end, min(end + stride, last)) - start
        rise = offsets[end : end + len(steps)] - offsets[start]
        lows = np.maximum(np.maximum.accumulate((rise - ERROR) / steps), low)
        highs = np.minimum(np.minimum.accumulate((rise + ERROR) / steps), high)
        apart = lows > highs
        fits = int(apart.argmax()) if apart.any() else len(steps)
        if fits:
            low, high = lows[fits - 1], highs[fits - 1]
        end += fits
        if fits < len(steps):
            break
        stride *= 2
    return end, 0 if end == start + 1 else int((low + high) / 2 * (1 << FRACTION))


def fit(offsets: np.ndarray) -> RankIndex:
    """Index of ascending offsets, one at least."""
    first, slopes, start = [], [], 0
    while start < len(offsets):
        end, slope = segment(offsets, start)
        first.append(start)
        slopes.append(slope)
        start = end
    firsts = np.array(first, np.int64)
    lines = RankIndex(firsts, offsets[firsts], np.array(slopes, np.int64), np.zeros(0, np.int8))
    missed = offsets - lines.predict(np.arange(len(offsets)))
    return RankIndex(lines.first, lines.base, lines.slope, missed.astype(np.int8))


def boundaries(text: bytes) -> np.ndarray:
    """Byte offsets at which units begin or end: 0, the ends of all units."""
    codes = np.frombuffer(text, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.concatenate([[0], ends, [len(codes)] if len(codes) else []]).astype(np.int64)


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four numbers of 32 bits, from the id."""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(x[i : i + 8], 16) for i in range(0, 32, 8))


@dataclass(frozen=True)
class Settings:
    seed: int = SEED
    cut: int = CUT
    suffix_first: int = SUFFIX_FIRST
    marks: tuple[str, str, str] = MARKS


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes, marks: tuple[bytes, ...]) -> bytes:
    p, s, m = marks
    return b"".join([s, suffix, p, prefix, m, middle] if form == SPM else [p, prefix, s, suffix, m, middle])


def reform(doc_id: int | None, text: bytes, settings: Settings) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, characters of prefix and middle, and output of a text."""
    marks = tuple(m.encode() for m in settings.marks)
    places = boundaries(text)
    n = len(places) - 1
    one, two, which, order = draws(doc_id, settings.seed)
    if not n or which % 100 >= settings.cut or any(m in text for m in marks):
        return n, PLAIN, None, None, text
    a, b = fit(places).offsets(np.sort(np.array([one % (n + 1), two % (n + 1)]))).tolist()
    form = SPM if order % 100 < settings.suffix_first else PSM
    prefix, middle = text[:a], text[a:b]
    return n, form, len(prefix.decode()), len(middle.decode()), joined(form, prefix, middle, text[b:], marks)


def transform(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain) and output of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [reform(i, t, settings) for i, t in zip(batch["doc"].to_pylist(), raw_texts(batch["t"]), strict=True)]
            n, form, prefix, middle, output = zip(*found, strict=True) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of this form was made from."""

    def after(mark: str) -> Column:
        return F.locate(mark, output) + len(mark)

    def between(first: str, last: str) -> Column:
        return F.substring(output, after(first), F.locate(last, output) - after(first))

    p, s, m = marks
    middle = F.substring(output, after(m), F.length(output))
    return (
        F.when(form == PSM, F.concat(between(p, s), middle, between(s, m)))
        .when(form == SPM, F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
