"""Catalog tables and temporary views."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.staging import delete, file_system


def read_region(spark: SparkSession, table: str, region: str, column: str = "region") -> DataFrame:
    """Rows of one region; on a table partitioned by it only that partition is read."""
    return spark.table(table).where(F.col(column) == F.lit(region))


def through_view(df: DataFrame, view: str, query: str) -> DataFrame:
    """Register ``df`` as a temporary view and run ``query`` against it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    placed = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{placed}")


def save_table(df: DataFrame, table: str) -> None:
    """Replace a table by ``df``."""
    df.write.mode("overwrite").saveAsTable(table)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Replace ``target`` by a copy of ``source``, in one overwrite."""
    save_table(spark.table(source), target)


def save_by_region(
    df: DataFrame, table: str, column: str = "region", gather: bool = True, regions: Sequence[str] | None = None
) -> None:
    """Replace a table by ``df``, one partition per region.

    With ``regions`` only those partitions are replaced; one that has no rows in
    ``df`` becomes empty, and rows of other regions are not written.

    The new rows are written first, then the table's partitions are switched to them
    (see ``swap_partitions``). Only a table of other columns is dropped and made anew.

    With ``gather`` the rows are shuffled first: AQE packs each region into few
    files and still splits a region that holds most of the rows. Without, each
    task writes the regions it has, which suits rows already read by region.
    """
    spark = df.sparkSession
    rows = df if regions is None else df.where(F.col(column).isin(*regions))
    rows = rows.hint("rebalance", column) if gather else rows
    if not spark.catalog.tableExists(table):
        rows.write.partitionBy(column).saveAsTable(table)
    elif regions is not None or same_layout(spark, rows, table, column):
        swap_partitions(rows, table, column, regions)
    else:
        rows.write.mode("overwrite").partitionBy(column).saveAsTable(table)


def same_layout(spark: SparkSession, rows: DataFrame, table: str, column: str) -> bool:
    """Whether a table has the columns of ``rows`` and is partitioned by ``column`` alone."""
    wanted = [(f.name, f.dataType) for f in rows.schema if f.name != column]
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return parts == [column] and wanted == [(f.name, f.dataType) for f in spark.table(table).schema if f.name != column]


def details(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """What the catalog says of a table, or of one partition; of equal names the first."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table} {partition}").collect()
    return {row.col_name: row.data_type for row in reversed(rows)}


def swap_partitions(rows: DataFrame, table: str, column: str, regions: Sequence[str] | None = None) -> None:
    """Write ``rows`` beside the table's files, then switch its partitions to them: ``regions``, or all.

    A write that fails leaves the table as it was. The switch is one catalog entry for each
    region, so a reader finds a region's old rows or its new ones; old files
    go after it. If it is interrupted, some regions are new and the others old,
    and the run can be repeated.
    """
    spark = rows.sparkSession
    about = details(spark, table)
    base = f"{about['Location'].rstrip('/')}/_{uuid.uuid4().hex}"
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(table).schema]
    try:
        rows.select(*typed).write.partitionBy(column).format(about["Provider"]).save(base)
    except Exception:
        delete(spark, base)
        raise
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    written = {name for name in children(spark, base) if "=" in name}
    present = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    wanted = written | present if regions is None else {names.getPartitionPathString(column, r) for r in regions}
    for name in sorted(wanted):
        value = names.unescapePathName(name.split("=", 1)[1])
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        spec = "NULL" if value == names.DEFAULT_PARTITION_NAME() else f"'{quoted}'"
        partition = f"PARTITION (`{column}` = {spec})"
        old = details(spark, table, partition)["Location"] if name in present else None
        if name in written:
            place = f"{base}/{name}".replace("\\", "\\\\").replace("'", "\\'")
            change = f"{partition} SET LOCATION" if old else f"ADD {partition} LOCATION"
            spark.sql(f"ALTER TABLE {table} {change} '{place}'")
        elif old:
            spark.sql(f"ALTER TABLE {table} DROP {partition}")
        if old:
            delete(spark, old)
            parent = old.rsplit("/", 1)[0]
            if parent.rsplit("/", 1)[-1].startswith("_") and not any("=" in x for x in children(spark, parent)):
                delete(spark, parent)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, place = file_system(spark, folder)
    return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []
