"""Quality classifier by compression with dictionaries of good and bad text.

Training takes a bounded sample of labelled rows: ``sample`` draws ``SAMPLE_ROWS`` ids of
each label in order of a hash of the id, and ``fit`` at most ``sample_pieces`` pieces of
the texts of each label. Half of the rows give two zstandard dictionaries; the other half
calibrates: a logistic regression on the normalised difference of the sizes to
which the two dictionaries compress a text, and on the size itself.

Scoring compresses every whole text, in pieces of ``PIECE`` bytes so that a
dictionary counts throughout a long text, in Arrow batches on the executors.

Defined cases: a null or empty text has difference and size zero and gets the score
the calibration gives to them; labels other than 0 and 1 and null texts are not
learnt from; without rows of both labels every score is the share of good rows
(0.5 without any). Repeated rows are scored one by one. The score lies in [0, 1].
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.llm.shared import kept, raw_texts, slices, stage

PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
#: Labelled ids drawn of each label.
SAMPLE_ROWS = 4_000
#: Fewer pieces than this make no dictionary.
LEAST_PIECES = 16


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good text (empty without training), and weights of the logistic regression."""

    bad: bytes
    good: bytes
    weights: tuple[float, ...]


def pieces(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


class Compressors:
    """Both compressors of a model; built once in each task."""

    def __init__(self, bad: bytes, good: bytes) -> None:
        self.each = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(d),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for d in (bad, good)
        ]

    def features(self, text: bytes) -> tuple[float, float]:
        """Normalised difference of the compressed sizes (above 0: nearer to good text), and the smaller size per byte."""
        parts = pieces(text)
        if not parts:
            return 0.0, 0.0
        bad, good = (sum(len(c.compress(x)) for x in parts) for c in self.each)
        return (bad - good) / max(bad, good), min(bad, good) / len(text)


def design(features: np.ndarray) -> np.ndarray:
    """Columns of the regression: constant, both features, their squares and product."""
    d, r = features[:, 0], features[:, 1]
    return np.column_stack([np.ones(len(d)), d, r, d * d, r * r, d * r])


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample(labels: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled ids of each label; so few ids are broadcast, and ``docs`` is not shuffled."""
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y")).where("i IS NOT NULL AND y IN (0, 1)").distinct()
    order = [F.xxhash64("i", F.lit("sample")), "i"]
    drawn = known.where("y = 0").orderBy(*order).limit(rows).unionByName(known.where("y = 1").orderBy(*order).limit(rows))
    texts = docs.select(F.col(doc_id).alias("i"), F.col(text).alias(text)).join(F.broadcast(drawn), "i")
    return stage(texts.select(text, F.col("y").alias(label)), "quality-sample")


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", sample_pieces: int = 24_000) -> Model:
    """Model from labelled rows, a bounded sample; at most ``sample_pieces`` pieces of each label come to the driver."""
    rows = labelled.select(F.col(text).alias("t"), F.col(label).cast("int").alias("y")).where(F.col("t").isNotNull() & F.col("y").isin(0, 1))
    rows = rows.withColumn("h", F.xxhash64("t", F.lit("sample")))
    cut = rows.select("y", "h", F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("t"), F.lit(1)) - 1) / PIECE).cast("int"))).alias("i"), "t")
    cut = cut.select("y", "h", "i", F.substring("t", F.col("i") * PIECE + 1, F.lit(PIECE)).alias("t"))
    texts: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for y in (0, 1):
        for r in cut.where(F.col("y") == y).orderBy(F.xxhash64("h", "i"), "t").limit(sample_pieces).collect():
            texts.setdefault((y, r.h), []).append((r.i, r.t.encode()))
    docs = [(y, h, b"".join(x for _, x in sorted(parts))) for (y, h), parts in sorted(texts.items())]
    learn = {y: [p for k, h, t in docs if k == y and h % 2 for p in pieces(t)] for y in (0, 1)}
    check = [(k, t) for k, h, t in docs if h % 2 == 0]
    share = np.mean([k for k, _, _ in docs]) if docs else 0.5
    if min(map(len, learn.values())) < LEAST_PIECES or len({k for k, _ in check}) < 2:
        return Model(b"", b"", (float(np.log((share + 1e-3) / (1 - share + 1e-3))),))
    bad, good = (dictionary(learn[y]) for y in (0, 1))
    tools = Compressors(bad, good)
    x = design(np.array([tools.features(t) for _, t in check]))
    return Model(bad, good, tuple(regression(x, np.array([k for k, _ in check], float))))


def dictionary(samples: list[bytes]) -> bytes:
    """Trained dictionary; where the samples are too few or too alike to train one, their text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def score(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = (), name: str = "score") -> DataFrame:
    """``keep`` columns and the column ``name``, the probability of good quality."""
    source = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    weights = np.array(model.weights)
    bad, good = model.bad, model.good
    key = f"compressors {hashlib.sha256(bad + good).hexdigest()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = kept(key, lambda: Compressors(bad, good)) if bad else None
        for batch in slices(batches):
            texts = raw_texts(batch["t"])
            z = design(np.array([tools.features(t) for t in texts])) @ weights if tools and texts else np.full(len(texts), weights[0])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(logistic(z), pa.float64())], names=[*batch.schema.names[:-1], "score"])

    scored = source.mapInArrow(run, schema)
    return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("score").alias(name))


def only_good(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of ``least`` or more."""
    name = "score_"
    while name in map(str.lower, docs.columns):
        name += "_"
    return score(docs, model, text, docs.columns, name).where(F.col(name) >= least).drop(name)
