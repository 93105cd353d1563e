"""Content-addressed WARC archive.

``write_archive`` makes a WARC record of each page and stores it in two tables of the
shared folder: ``payloads`` holds the bytes of each distinct payload once, under its
SHA-256; ``headers`` holds the exact header bytes of each record (WARC headers, and
for a response the HTTP header) and the digest of its payload. Of records with
equal payloads of at least ``least_bytes`` bytes, the one with the largest page id is
the response; the others are revisits that refer to it.

``read_records`` reconstructs the exact bytes of the records through a join of the two tables, a revisit's also with
the payload that it shares. ``read_back`` takes these records apart again: what it returns of a payload is
taken from the rebuilt bytes, and they are checked against both digests and the stored length.

Payloads that occur once, nearly all, are stored where they lie; only those of several pages are shuffled,
one of each from a task. In the join by digest hot keys are on the side of the small header rows, where the engine can
split them.

Defined cases: a null html is an empty payload; a null url is an empty target; of
equal largest page ids any one row is the response; null page ids rank below all
others. An empty table gives empty tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.llm.shared import new_path, raw_texts, slices, stage
from salesprep.operators.lookup import join_lookup
from salesprep.staging import stage_measured

HTTP_HEADER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    payloads: str
    headers: str


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = raw_texts(batch["t"])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-1],
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([base32_sha1(t) for t in texts], pa.string()),
                pa.array(map(len, texts), pa.int64(), size=len(texts)),
            ],
            names=["page", "row", "url", "sha256", "sha1", "n_bytes"],
        )


def one_line(text: str | None) -> str:
    """A header value: what would end the line is percent-encoded."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def record_id(page: int | None, row: int) -> str:
    return f"<urn:page:{'' if page is None else page}:{row}>"


def header(page: int | None, row: int, url: str | None, sha1: str, n_bytes: int, first: tuple | None) -> bytes:
    """Header bytes of a record; ``first`` is the (page, row) of the response for a revisit."""
    http = HTTP_HEADER + b"Content-Length: %d\r\n\r\n" % n_bytes
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: {record_id(page, row)}",
        f"WARC-Target-URI: {one_line(url)}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if first else n_bytes)}",
    ]
    if first:
        fields += [f"WARC-Refers-To: {record_id(*first)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + http


def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = batch.to_pylist()
        made = [header(r["page"], r["row"], r["url"], r["sha1"], r["n_bytes"], (r["first_page"], r["first_row"]) if r["first_row"] is not None else None) for r in rows]
        yield pa.RecordBatch.from_arrays([batch["row"], batch["sha256"], pa.array(made, pa.binary())], names=["row", "sha256", "header"])


def write_archive(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    spark = pages.sparkSession
    source = pages.select(F.col(page_id).cast("long").alias("page"), F.monotonically_increasing_id().alias("row"), F.col(url).alias("url"), F.col(html).alias("t"))
    rows = stage(source.mapInArrow(digests, "page long, row long, url string, sha256 binary, sha1 string, n_bytes long"), "warc-digests")
    firsts = rows.groupBy("sha256").agg(F.max(F.struct(F.coalesce("page", F.lit(-(1 << 63))).alias("p"), "row", "page")).alias("f"))
    firsts = stage(firsts.select("sha256", F.col("f.page").alias("first_page"), F.col("f.row").alias("first_row")), "warc-firsts")
    refers = (F.col("first_row") != F.col("row")) & (F.col("n_bytes") >= least_bytes)
    linked = rows.join(firsts, "sha256").select("page", "row", "url", "sha256", "sha1", "n_bytes", F.when(refers, F.col("first_page")).alias("first_page"), F.when(refers, F.col("first_row")).alias("first_row"))
    archive = Archive(new_path(spark, "warc-payloads"), new_path(spark, "warc-headers"))
    linked.mapInArrow(headers, "row long, sha256 binary, header binary").write.parquet(archive.headers)
    payload = F.coalesce(F.col(f"`{html}`").cast("string").cast("binary"), F.lit(b""))
    stored = pages.select(payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    often, size = stage_measured(rows.groupBy("sha256").count().where("count > 1").select(F.lower(F.hex("sha256")).alias("key")), "warc-often")
    once = join_lookup(stored, often, ["key"], "left_anti", size=size)
    several = join_lookup(stored, often, ["key"], "left_semi", size=size).groupBy("key").agg(F.first("payload").alias("payload"))
    once.unionByName(several).select(F.unhex("key").alias("sha256"), "payload").write.parquet(archive.payloads)
    return archive


def parse_record(key: bytes, record: bytes) -> tuple:
    """Page, type, length and digest of the payload, and the page referred to, of a record with its payload."""
    head, _, rest = record.partition(END)
    http, _, rest = rest.partition(END)
    payload, fields = rest[: -len(END)], dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    digest = base32_sha1(payload)
    whole = rest.endswith(END) and int(http.rpartition(b": ")[2]) == len(payload)
    if not whole or hashlib.sha256(payload).digest() != key or fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    page = lambda name: int(x) if name in fields and (x := fields[name].split(":")[2]) else None
    return page("WARC-Record-ID"), fields["WARC-Type"], len(payload), digest, page("WARC-Refers-To")


def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [parse_record(*x) for x in zip(batch["sha256"].to_pylist(), batch["record"].to_pylist(), strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * 5
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def read_back(spark: SparkSession, archive: Archive) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from its rebuilt bytes; damaged or missing payloads raise."""
    records = read_records(spark, archive, originals=True).select("sha256", "record")
    found = records.mapInArrow(parsed, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def read_records(spark: SparkSession, archive: Archive, originals: bool = False) -> DataFrame:
    """row, sha256 and record (its exact bytes) of every record; with ``originals`` also revisits carry the payload they share."""
    stored = spark.read.parquet(archive.headers).join(spark.read.parquet(archive.payloads), "sha256", "left")
    payload = F.coalesce("payload", F.raise_error(F.lit("a record's payload is missing")).cast("binary"))
    revisit = F.expr("instr(decode(header, 'UTF-8'), '\r\nWARC-Type: revisit\r\n') > 0")
    body = payload if originals else F.when(revisit, F.lit(b"")).otherwise(payload)
    return stored.select("row", "sha256", F.concat("header", body, F.lit(END)).alias("record"))
