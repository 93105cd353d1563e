"""Most recent months, and what a store was in its most recent month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesprep.functions.months import month_to_date
from salesprep.operators.lookup import LIMITS, Limits, join_lookup
from salesprep.staging import Size, size_columns, stage, stage_measured, stage_observed


def months_present(df: DataFrame) -> DataFrame:
    """Well-formed months that occur, per region."""
    return df.where(month_to_date(F.col("year_month")).isNotNull()).select("region", "year_month").distinct()


def last_months(df: DataFrame, count: int) -> DataFrame:
    """The last ``count`` months that occur in each region; all when there are fewer.

    Distinct months are ranked, never the fact: a region has one row per month.
    """
    newest_first = Window.partitionBy("region").orderBy(F.col("year_month").desc())
    return (
        months_present(df)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= count)
        .select("region", "year_month")
    )


def keep_last_months(df: DataFrame, count: int, limits: Limits = LIMITS) -> DataFrame:
    """Rows of the last ``count`` months of their region.

    Rows older than the oldest of these months are ruled out by a plain filter, which reaches what ``df`` is made of.
    """
    wanted, values = stage_observed(
        last_months(df, count), "last-months", *size_columns(["region", "year_month"]), F.min("year_month").alias("oldest")
    )
    size = Size(values.get("row_count", 0), values.get("byte_count", 0))
    recent = df.where(F.col("year_month") >= F.lit(values.get("oldest")))
    return join_lookup(recent, wanted, ["region", "year_month"], "left_semi", size=size, limits=limits)


def store_months(sales: DataFrame) -> DataFrame:
    """A small row per store, month, category and bucket: its rows (``_rows``) and, where there is one, its greatest volume.

    Counts and maxima of numbers, so the fact is hashed, not sorted, and combined
    before the shuffle. Classes, months and volumes of stores follow from it.
    """
    volume = [F.max("vol_sales").alias("vol_sales")] if "vol_sales" in sales.columns else []
    keys = ("region", "store_code", "year_month", "outlet_category_name", "bucket")
    return sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *volume)


def latest_class(sales: DataFrame) -> DataFrame:
    """Category and bucket of each store in its last month, and its rows (``_rows``).

    A missing month counts as the last one. Ties go to the greatest category,
    then bucket.
    """
    return _class_of(sales, F.count(F.lit(1)))


def class_of(stores: DataFrame) -> DataFrame:
    """``latest_class`` from ``store_months``."""
    return _class_of(stores, F.sum("_rows"))


def _class_of(rows: DataFrame, count: Column) -> DataFrame:
    """One row per store. Spark sorts for a maximum of texts; a hash comes first, as codes that begin alike would be compared whole."""
    newest = F.struct(F.col("year_month").isNull().alias("undated"), "year_month", "outlet_category_name", "bucket")
    return (
        rows.groupBy(F.xxhash64("region", "store_code").alias("_hash"), "region", "store_code")
        .agg(F.max(newest).alias("newest"), count.alias("_rows"))
        .select(
            "region",
            "store_code",
            F.col("newest.outlet_category_name").alias("latest_category"),
            F.col("newest.bucket").alias("latest_bucket"),
            "_rows",
        )
    )


def apply_latest_class(sales: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Give all rows of a store the category and bucket of its last month."""
    classes, size = stage_measured(latest_class(sales), "latest-class")
    keys = ["region", "store_code"]
    joined = join_lookup(
        sales,
        classes.drop("_rows"),
        keys,
        null_safe=keys,
        size=size,
        counts=classes.select(*keys, "_rows"),
        limits=limits,
    )
    return joined.withColumns(
        {"outlet_category_name": F.col("latest_category"), "bucket": F.col("latest_bucket")}
    ).drop("latest_category", "latest_bucket")


def monthly_volume(sales: DataFrame) -> DataFrame:
    """One small row per store and month: its greatest volume."""
    return sales.groupBy("region", "store_code", "year_month").agg(F.max("vol_sales").alias("vol_sales"))


def active_stores(sold: DataFrame, count: int, limits: Limits = LIMITS) -> DataFrame:
    """Stores with volume in the last ``count`` months of their region; only rows of these months are moved."""
    recent = join_lookup(sold, last_months(sold, count), ["region", "year_month"], "left_semi", limits=limits)
    return monthly_volume(recent).where(F.col("vol_sales") > 0).select("region", "store_code").distinct()


def keep_active_stores(
    df: DataFrame, cleaned: DataFrame | None = None, count: int = 4, limits: Limits = LIMITS
) -> DataFrame:
    """Rows of ``df`` whose store is active in ``cleaned`` (``df`` itself when not given)."""
    rows = df if cleaned is None else cleaned
    sold = stage(rows.select("region", "store_code", "year_month", "vol_sales"), "sold")
    stores, size = stage_measured(active_stores(sold, count, limits), "active-stores")
    keys = ["region", "store_code"]
    return join_lookup(df, stores, keys, "left_semi", null_safe=keys, size=size, limits=limits)
