"""URL filter: rules looked up in memory-mapped sorted arrays of 64-bit digests.

A rule is a host and a path prefix. It fits a url whose host is the rule's host or
a subdomain of it and whose path starts with the rule's path; of several, the
longest rule string (host and path together) decides, then the longest host.

The rules are sorted by XXH64 and laid down as segment files in the shared folder.
``addFile`` brings them to each executor once, where all Python workers map the
same pages. A batch of urls becomes a list of candidate strings (host suffixes
times the path lengths that occur in rules); one vectorised binary search finds
their digests, and the stored strings confirm the hits, so that a collision of
digests never decides.

Defined cases: a null url or one without ``://`` has empty host and path and fits no
rule; a rule given twice counts once, and block wins over allow; null rules are
left out; without rules every url is allowed. Repeated url rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.llm.shared import new_path, slices

SEED = 42
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = T.StructType([T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])


@dataclass(frozen=True)
class UrlIndex:
    """Names of the segment files, and the path lengths (in characters) that rules have."""

    segments: tuple[str, ...]
    path_lengths: tuple[int, ...]


def split_url(url: str) -> tuple:
    """Columns ``host`` and ``path`` of a url column."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host.alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path")


def pack(rows: Sequence) -> bytes:
    """A segment: count, sorted digests, string offsets, lengths of hosts, verdicts, strings."""
    texts = [(r.host + r.path).encode() for r in rows]
    keys = np.array([r.digest for r in rows], "<i8")
    ends = np.cumsum([0, *map(len, texts)]).astype("<i8")
    hosts = np.array([len(r.host.encode()) for r in rows], "<i8")
    blocks = np.array([r.blocks for r in rows], "<i8")
    return b"".join([np.array([len(rows)], "<i8").tobytes(), keys.tobytes(), ends.tobytes(), hosts.tobytes(), blocks.tobytes(), *texts])


class Segment:
    """A mapped segment file."""

    def __init__(self, path: str) -> None:
        n = int(np.memmap(path, "<i8", "r", shape=(1,))[0])
        words = np.memmap(path, "<i8", "r", shape=(4 * n + 2,))
        self.keys, self.ends = words[1 : n + 1], words[n + 1 : 2 * n + 2]
        self.hosts, self.blocks = words[2 * n + 2 : 3 * n + 2], words[3 * n + 2 : 4 * n + 2]
        self.strings = np.memmap(path, np.uint8, "r", offset=8 * (4 * n + 2)) if self.ends[-1] else np.zeros(0, np.uint8)

    def text(self, i: int) -> bytes:
        return self.strings[self.ends[i] : self.ends[i + 1]].tobytes()

    def probe(self, digests: np.ndarray, texts: list[bytes], hosts: list[int]) -> Iterator[tuple[int, bool]]:
        """Candidates that are rules, with whether they block; equal digests are told apart by host length and string."""
        at = np.searchsorted(self.keys, digests)
        inside = at < len(self.keys)
        inside[inside] = self.keys[at[inside]] == digests[inside]
        for k in np.flatnonzero(inside):
            i = int(at[k])
            while i < len(self.keys) and self.keys[i] == digests[k]:
                if self.hosts[i] == hosts[k] and self.text(i) == texts[k]:
                    yield int(k), bool(self.blocks[i])
                    break
                i += 1


def build_index(rules: DataFrame, segment_rows: int = 1_000_000) -> UrlIndex:
    """Index of rules (columns host, path, verdict). The driver holds one segment at a time."""
    spark = rules.sparkSession
    clean = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
        .where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
        .groupBy("host", "path")
        .agg(F.max((F.col("verdict") == BLOCK).cast("int")).alias("blocks"))
        .withColumn("digest", F.xxhash64(F.concat("host", "path")))
    )
    lengths = [r[0] for r in clean.select(F.length("path")).distinct().collect()]
    names, rows = [], []
    for row in clean.orderBy("digest").toLocalIterator():
        rows.append(row)
        if len(rows) == segment_rows:
            names.append(ship(spark, pack(rows)))
            rows = []
    if rows:
        names.append(ship(spark, pack(rows)))
    return UrlIndex(tuple(names), tuple(sorted(lengths)))


def ship(spark: SparkSession, content: bytes) -> str:
    """Write a file into the shared folder and have every executor fetch it."""
    path = new_path(spark, "url-segment")
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    out.write(content)
    out.close()
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def candidates(host: str, path: str, lengths: tuple[int, ...]) -> Iterator[tuple[str, str]]:
    """Strings of the rules that could fit: host suffixes at dots, and path prefixes of known lengths."""
    starts = [0, *(i + 1 for i, c in enumerate(host) if c == ".")]
    for start in starts if host else []:
        for n in lengths:
            if n > len(path):
                break
            yield host[start:], path[:n]


def judge(urls: DataFrame, index: UrlIndex, url: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns with host, path, rule (null if none fits) and verdict of each row."""
    names = [f"k{i}" for i in range(len(keep))]
    split = urls.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{url}`").alias("u"))
    split = split.select(*names, *split_url("u"))
    schema = T.StructType([*split.schema.fields, *FOUND.fields])
    file_names, lengths = index.segments, index.path_lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = [Segment(SparkFiles.get(x)) for x in file_names]
        for batch in slices(batches, 2 << 20):
            owners, texts, hosts, weights = [], [], [], []
            for i, (h, p) in enumerate(zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)):
                for x, y in candidates(h, p, lengths):
                    owners.append(i)
                    texts.append((x + y).encode())
                    hosts.append(len(x.encode()))
                    weights.append((len(x) + len(y), len(x)))
            digests = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in texts), np.uint64, len(texts)).view(np.int64)
            best: dict[int, tuple] = {}
            for segment in segments:
                for k, blocks in segment.probe(digests, texts, hosts):
                    best[owners[k]] = max(best.get(owners[k], ((-1, -1), b"", False)), (weights[k], texts[k], blocks))
            rules = [best[i][1].decode() if i in best else None for i in range(batch.num_rows)]
            verdicts = [BLOCK if i in best and best[i][2] else ALLOW for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=[*batch.schema.names, "rule", "verdict"])

    found = split.mapInArrow(run, schema)
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "host", "path", "rule", "verdict")
