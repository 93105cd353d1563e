"""JDBC tables, read in parallel by month."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_properties(driver: str, user: str, password: str, fetch_size: int = 10_000) -> dict[str, str]:
    return {"driver": driver, "user": user, "password": password, "fetchsize": str(fetch_size)}


def month_predicates(column: str, first_month: str, last_month: str) -> list[str]:
    """One predicate per month (``yyyyMM`` bounds, both included): one task, one query each."""

    def number(month: str) -> int:
        return int(month[:4]) * 12 + int(month[4:]) - 1

    return [
        f"{column} = '{month // 12:04d}/{month % 12 + 1:02d}'"
        for month in range(number(first_month), number(last_month) + 1)
    ]


def histogram_table(table: str, column: str, first_month: str, last_month: str) -> str:
    """Subquery, to be read in place of ``table``: rows per month (``yyyyMM`` bounds, both included), grouped by the database."""
    first, last = (f"{month[:4]}/{month[4:]}" for month in (first_month, last_month))
    return (
        f"(SELECT {column} AS sales_month, COUNT(*) AS row_count FROM {table} "
        f"WHERE {column} BETWEEN '{first}' AND '{last}' GROUP BY {column}) months"
    )


def split_predicates(
    histogram: Iterable[tuple[str, int]], column: str, bucket: str | None = None, rows_per_task: int = 5_000_000
) -> list[str]:
    """Disjoint predicates that cover the months of a histogram, of about ``rows_per_task`` rows each.

    ``bucket`` is an expression in the database's own SQL that deals rows evenly over numbers from 0 to
    ``{buckets}`` - 1, such as ``MOD(invoice_id, {buckets})``; rows without a number go with 0. A month beyond the bound
    is split by it; without one it is an error, as one task would read it all.
    """
    predicates = []
    for month, rows in sorted(histogram):
        quoted = month.replace("'", "''")
        one = f"{column} = '{quoted}'"
        parts = max(1, -(-rows // rows_per_task))
        if parts > 1 and bucket is None:
            raise ValueError(f"month {month} has {rows} rows; give an expression that splits it")
        number = bucket.format(buckets=parts) if parts > 1 else ""
        for k in range(parts):
            orphans = f" OR {number} IS NULL" if k == 0 else ""
            predicates.append(f"{one} AND ({number} = {k}{orphans})" if parts > 1 else one)
    return predicates


def read_months(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    first_month: str,
    last_month: str,
    column: str = "year_month",
    bucket: str | None = None,
    rows_per_task: int = 5_000_000,
) -> DataFrame:
    """Months of a table, split so that no task reads many more than ``rows_per_task`` rows.

    A grouped query, one row per month, tells how many rows each month has.
    """
    grouped = histogram_table(table, column, first_month, last_month)
    counts = [tuple(row) for row in read_jdbc(spark, url, grouped, properties, unsplit=True).collect()]
    # a table without rows of these months still has its columns
    return read_jdbc(spark, url, table, properties, split_predicates(counts, column, bucket, rows_per_task) or ["1 = 0"])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: Sequence[str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
    unsplit: bool = False,
) -> DataFrame:
    """Read a table.

    ``predicates`` (disjoint, covering the wanted rows) or ``partition`` (numeric
    column, lower, upper, number of partitions) split the read over tasks; with
    ``unsplit`` one task reads everything, which has to be asked for.
    """
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if partition is not None:
        column, lower, upper, number = partition
        return spark.read.jdbc(
            url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=number, properties=properties
        )
    if not unsplit:
        raise ValueError(f"give predicates or a partition to split the read of {table}, or ask for one task")
    return spark.read.jdbc(url, table, properties=properties)
