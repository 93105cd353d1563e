"""Delimited files and dated snapshots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.contracts import POS_FILE, POS_NAMES, check_contract
from salesprep.functions.months import snapshot_tag
from salesprep.staging import file_system

#: What a file system's name patterns give a meaning to.
GLOB = r"[\[\]{}*?\\]"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Read delimited files with a header.

    With a schema the header is checked against it, so a moved column raises
    instead of landing in the wrong place. Without one all columns are strings;
    types are never inferred, which also saves a pass over the data.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_lookup(
    spark: SparkSession, path: str, contract: T.StructType, names: Sequence[str], sep: str = ","
) -> DataFrame:
    """The contract's columns of a lookup file, found by header name, under the library's names.

    Other columns of the file are not parsed further; all codes stay strings.
    """
    return check_contract(read_csv(spark, path, sep=sep), contract).select(*contract.names).toDF(*names)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write delimited files with a header, keeping the spaces around values."""
    (
        df.write.option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def snapshot_names(spark: SparkSession, folder: str, holds: str = "") -> list[str]:
    """Names of the snapshots in ``folder`` that hold a text, in order.

    A snapshot is a file, or a folder of part files. The file system matches the names at the
    top of ``folder``; nothing below them is listed. Names that begin with ``_`` or ``.`` are hidden.
    """
    literal = re.sub(GLOB, r"\\\g<0>", holds)
    files, place = file_system(spark, f"{folder.rstrip('/')}/*{literal}*")
    names = [found.getPath().getName() for found in files.globStatus(place) or ()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a file, or a folder with a file in it; listed only up to the first one."""
    files, place = file_system(spark, path)
    return files.listFiles(place, True).hasNext()


def latest_snapshot(spark: SparkSession, folder: str, pattern: str | Column) -> str:
    """Path of the snapshot with the greatest name among those that hold ``pattern``."""
    wanted = pattern if isinstance(pattern, str) else spark.range(1).select(pattern).first()[0]
    for name in reversed(snapshot_names(spark, folder, wanted)):
        path = f"{folder.rstrip('/')}/{name}"
        if has_files(spark, path):
            return path
    raise FileNotFoundError(f"no snapshot in {folder} has the wanted name")


def read_latest(
    spark: SparkSession, folder: str, pattern: str | Column, schema: T.StructType | None = None, sep: str = ","
) -> DataFrame:
    """Read only the newest snapshot; older ones are not opened."""
    return read_csv(spark, latest_snapshot(spark, folder, pattern), schema, sep)


def read_dated(
    spark: SparkSession,
    folder: str,
    prefix: str,
    as_of: Column,
    schema: T.StructType | None = None,
    sep: str = "|",
    view: str | None = None,
) -> DataFrame:
    """Read the newest snapshot whose name holds ``prefix`` and the tag of ``as_of``."""
    df = read_latest(spark, folder, F.concat(F.lit(prefix), snapshot_tag(as_of)), schema, sep)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def read_pos(spark: SparkSession, folder: str, prefix: str, as_of: Column, view: str | None = None) -> DataFrame:
    """The POS map of the run date under the library's names; also a view of the file when named."""
    dated = read_dated(spark, folder, prefix, as_of, view=view)
    return check_contract(dated, POS_FILE).select(*POS_FILE.names).toDF(*POS_NAMES)
