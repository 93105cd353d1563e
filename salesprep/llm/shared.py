"""Helpers of this package: the shared work folder, staged tables, texts of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.staging import register


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it belongs to the open scope (see ``salesprep.staging``).

    The folder is the session's ``spark.checkpoint.dir``. Only a local session may
    lack it; then a new one is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    return register(f"{root.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back; cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows, as a power of two, that ``shelve`` keeps together.
CHUNK_BITS = 12
#: Bytes that a writer of shelved rows gathers before it writes them.
ROW_GROUP_BYTES = 32 << 20


def shelve(df: DataFrame, name: str) -> DataFrame:
    """``df`` written into the shared folder, so that small tables can meet its rows without moving them.

    Returns the columns as c0, c1, .. with ``row``, a number of its own for each row, and
    ``chunk``, the same for up to 2 ** ``CHUNK_BITS`` neighbours. The files are bucketed by ``chunk``,
    so a join on it (``met``) shuffles only the other side.
    """
    spark = df.sparkSession
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).withColumn("row", F.monotonically_increasing_id())
    chunked = numbered.withColumn("chunk", F.shiftright("row", CHUNK_BITS))
    path = new_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunked.write.bucketBy(buckets, "chunk").format("parquet").option("path", path).option("parquet.block.size", ROW_GROUP_BYTES).saveAsTable(table)
    shelf = spark.table(table)
    # only the name goes: the files are the caller's, and the plan knows them
    spark.sql(f"DROP TABLE {table}")
    return shelf


def met(shelf: DataFrame, small: DataFrame, how: str) -> DataFrame:
    """Join of shelved rows with ``small`` (column ``row``, at most one for each, and others) that leaves them where they lie.

    ``chunk`` is the only key of the join: with ``row`` as a second one Spark would
    shuffle both sides. A row is compared with those of ``small`` in its chunk.
    """
    other = small.withColumnRenamed("row", "row_").withColumn("chunk_", F.shiftright("row_", CHUNK_BITS)).hint("shuffle_hash")
    same = (F.col("chunk") == F.col("chunk_")) & (F.col("row") - F.col("row_") == 0)
    return shelf.join(other, same, how)


_kept: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task under ``key``; it keeps one such thing at a time.

    A worker goes on to other operators' tasks, so what the last one kept is dropped first, and its memory given back.
    """
    if key not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)
        _kept[key] = make()
    return _kept[key]


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice has about ``most_bytes`` of data, one row at least."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, most_bytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; nulls are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).astype(np.int64, copy=False), pa.int64())
