"""One row per key.

``row_number() = 1`` is planned with a group limit in front of the shuffle, so
each map task sends at most one row per key, however many copies it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The most selective number comes first: Spark sorts by the first column's bytes and compares rows only where they are equal.
SALES_KEY = ("value_sales", "product_sku_code", "store_code", "year_month", "vol_sales", "region", "brand", "city")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order. Null is a key of its own."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def dedupe_sales(sales: DataFrame, first: str = "address") -> DataFrame:
    """One row per sale of a region.

    Of several the one with the least ``first`` column stays, then the least of
    every other column, nulls first, so the result does not depend on input order.
    """
    rest = [c for c in sales.columns if c not in SALES_KEY and c != first]
    return first_per_key(sales, SALES_KEY, [F.col(c).asc_nulls_first() for c in (first, *rest)])


def one_area_per_partner(areas: DataFrame) -> DataFrame:
    """The least area of each partner."""
    return areas.groupBy("partner_code").agg(F.min("new_area").alias("new_area"))
