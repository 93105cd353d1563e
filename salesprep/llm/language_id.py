"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Characters are code points after lower-casing; n-grams of one to ``N`` characters
are hashed into ``BUCKETS`` buckets, within whole texts. Training counts them on
the executors: each task sums the counts of its texts per language, and Spark sums
the tasks' sparse counts, so that at most languages times ``BUCKETS`` numbers reach
the driver. They become a matrix of log-probabilities that is broadcast (its size
is languages x ``BUCKETS`` x 4 bytes; where that would be over ``MATRIX_BYTES``, neighbouring buckets are
one, so that any number of languages fits). Scoring makes a sparse matrix of the bucket counts of a batch's texts
(buckets sorted per text, equal ones counted) and multiplies it by the log-probabilities: the rows of its buckets,
times their counts, are summed per text by one ``reduceat``.

The score is the posterior probability of the predicted language with the
log-likelihood tempered to ``EVIDENCE`` n-grams, as n-grams of a text are far
from independent.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows with
null text or null language are not learnt from; without any learnt language all
is ``und``; of equally likely languages the first by name wins. Repeated rows are
predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.llm.shared import slices

N = 3
BUCKETS = 1 << 16
EVIDENCE = 20.0
UNDEFINED = "und"
#: Characters whose n-grams are worked out at once; longer texts come in parts that overlap.
PART = 1 << 18
#: Bytes that a broadcast matrix may have.
MATRIX_BYTES = 256 << 20
#: Numbers of a product of a bucket's log-probabilities and counts that are held at once; one text's always are.
PRODUCT = 4 << 20


@dataclass(frozen=True)
class Model:
    """Languages in order, and per bucket the log-probability in each, and log-priors."""

    langs: tuple[str, ...]
    matrix: np.ndarray
    priors: np.ndarray

    @property
    def shift(self) -> int:
        """Bits by which buckets are made coarser."""
        return (BUCKETS // max(len(self.matrix), 1)).bit_length() - 1


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, in parts of bounded size."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for start in range(0, len(points), PART):
        part = points[start : start + PART + N - 1]
        fresh = min(PART, len(points) - start)
        hashed = np.zeros(len(part), np.uint64)
        for n in range(1, N + 1):
            if len(part) < n:
                break
            hashed = hashed[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :] + np.uint64(n)
            mixed = hashed ^ (hashed >> np.uint64(29))
            yield ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)[:fresh]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """Model from all rows of ``labelled`` that have a text and a language."""
    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("y")).where("t IS NOT NULL AND y IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in slices(batches):
            for t, y in zip(batch["t"].to_pylist(), batch["y"].to_pylist(), strict=True):
                into = totals.setdefault(y, np.zeros(BUCKETS, np.int64))
                texts[y] = texts.get(y, 0) + 1
                for found in grams(t):
                    if len(found) * 8 < BUCKETS:
                        np.add.at(into, found, 1)
                    else:
                        into += np.bincount(found, minlength=BUCKETS)
        for y, into in totals.items():
            seen = np.flatnonzero(into)
            buckets = np.append(seen, -1)
            yield pa.RecordBatch.from_arrays([pa.array([y] * len(buckets), pa.string()), pa.array(buckets, pa.int64()), pa.array(np.append(into[seen], texts[y]), pa.int64())], names=["y", "b", "n"])

    sums = rows.mapInArrow(count, "y string, b long, n long").groupBy("y", "b").agg(F.sum("n").alias("n"))
    per_lang = sums.groupBy("y").agg(F.collect_list(F.struct("b", "n")).alias("c"))
    langs, counts, texts = [], [], []
    for row in sorted(per_lang.toLocalIterator(), key=lambda r: r.y):
        into = np.zeros(BUCKETS)
        for b, n in row.c:
            if b >= 0:
                into[b] = n
            else:
                texts.append(n)
        langs.append(row.y)
        counts.append(into)
    table = np.array(counts).reshape(len(langs), BUCKETS)
    while table.size * 4 > MATRIX_BYTES and table.shape[1] > 1:
        table = table[:, ::2] + table[:, 1::2]
    table += smoothing
    matrix = np.log(table / table.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return Model(tuple(langs), np.ascontiguousarray(matrix), np.log(np.array(texts, float) / max(sum(texts), 1)))


def counted(text: str, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text, in order, and how often each occurs."""
    found = np.sort(np.concatenate([(x >> shift).astype(np.uint16) for x in grams(text)]), kind="stable")
    starts = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    return found[starts], np.diff(np.append(starts, len(found)))


def log_likelihoods(rows: list[tuple[np.ndarray, np.ndarray]], matrix: np.ndarray) -> np.ndarray:
    """The sparse matrix of these rows (buckets and counts, none empty) times ``matrix``, in parts of bounded size."""
    out = np.zeros((len(rows), matrix.shape[1]))
    ends = np.cumsum([len(b) for b, _ in rows])
    most, first = max(1, PRODUCT // max(1, matrix.shape[1])), 0
    while first < len(rows):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        buckets, counts = (np.concatenate(x) for x in zip(*rows[first:last], strict=True))
        starts = np.append(0, ends[first : last - 1] - before)
        out[first:last] = np.add.reduceat(matrix[buckets] * counts[:, None].astype(np.float64), starts, axis=0)
        first = last
    return out


def predict(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of each row."""
    source = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast((model.matrix, model.priors, model.shift))
    langs = model.langs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, priors, shift = shared.value
        for batch in slices(batches):
            texts = batch["t"].to_pylist()
            at = [i for i, t in enumerate(texts) if langs and t and has_letter(t)]
            preds, scores = [UNDEFINED] * len(texts), [0.0] * len(texts)
            if at:
                rows = [counted(texts[i], shift) for i in at]
                share = np.array([min(1.0, EVIDENCE / int(c.sum())) for _, c in rows])
                z = (log_likelihoods(rows, matrix) + priors) * share[:, None]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                for i, best, row in zip(at, p.argmax(axis=1).tolist(), p, strict=True):
                    preds[i], scores[i] = langs[best], float(row[best])
            extra = [pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *extra], names=[*batch.schema.names[:-1], "lang_pred", "score"])

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
