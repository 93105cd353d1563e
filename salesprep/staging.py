"""Intermediate tables in the shared work folder.

A staged table cuts the lineage, survives the loss of executors, and gives
Catalyst the true size of what was computed. Within a ``scope`` it lives as long
as something that is kept reads it; its files are deleted when the scope ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce
from operator import add

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """Folder of this application under ``spark.checkpoint.dir``, which must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/salesprep/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Scope:
    """The staged tables of one piece of work."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def read_by(self, *tables: DataFrame | None) -> set[str]:
        """The scope's staged tables that these read."""
        read = {part for df in tables if df is not None for file in df.inputFiles() for part in file.split("/")}
        return {path for path in self.paths if path.rsplit("/", 1)[-1] in read}

    def keep(self, *tables: DataFrame | None) -> None:
        """The staged tables that these read outlive the scope; the scope around it, if any, takes them over."""
        self.kept |= self.read_by(*tables)

    def drop(self, spark: SparkSession, *tables: DataFrame) -> None:
        """Delete the staged tables that these read now: nothing reads them any more."""
        for path in self.read_by(*tables):
            self.paths.remove(path)
            delete(spark, path)


_open: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """What is staged inside and not kept is deleted at the end; all of it if the work fails."""
    own, outer = Scope(), _open.get()
    token = _open.set(own)
    done = False
    try:
        yield own
        done = True
    finally:
        _open.reset(token)
        kept = own.kept if done else set()
        if outer is not None:
            outer.paths += [path for path in own.paths if path in kept]
        for path in own.paths:
            if path not in kept:
                delete(spark, path)


def register(path: str) -> str:
    """``path`` belongs to the innermost open scope; outside of any it stays."""
    if (own := _open.get()) is not None:
        own.paths.append(path)
    return path


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a new folder and read it back with the same columns."""
    spark = df.sparkSession
    path = register(new_path(spark, name))
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def size_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates: rows, and bytes of all values as text."""
    width = reduce(add, [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in columns])
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(width), F.lit(0)).alias("byte_count")]


def measure(df: DataFrame) -> Size:
    """Size of ``df``; one row comes back."""
    size = df.agg(*size_columns(df.columns)).first()
    return Size(size.row_count, size.byte_count)


def stage_measured(df: DataFrame, name: str) -> tuple[DataFrame, Size]:
    """Stage ``df`` and measure it while it is written."""
    staged, values = stage_observed(df, name, *size_columns(df.columns))
    return staged, Size(values.get("row_count", 0), values.get("byte_count", 0))


def stage_observed(
    df: DataFrame, name: str, *aggregates: Column, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, dict]:
    """Stage ``df`` and take named aggregates of it while it is written."""
    seen = Observation()
    return stage(df.observe(seen, *aggregates), name, partition_by), observed(seen)


def observed(seen: Observation) -> dict:
    """Values of an observation whose action has ended; none where the planner found no rows and dropped the node."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}
