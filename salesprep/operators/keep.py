"""Keep or drop rows by a list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep import markets
from salesprep.functions import text
from salesprep.operators.lookup import LIMITS, Limits, join_lookup
from salesprep.staging import Size


def listed_distributors(df: DataFrame, distributors: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Rows whose distributor is listed."""
    listed = distributors.select("distributor_code").distinct()
    return join_lookup(df, listed, ["distributor_code"], "left_semi", limits=limits)


def route_stores(df: DataFrame, route: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Rows whose store is on a planned route."""
    stores = route.select(F.col("store_id").alias("store_code")).distinct()
    return join_lookup(df, stores, ["store_code"], "left_semi", limits=limits)


def without_counters(
    df: DataFrame, counters: DataFrame, size: Size | None = None, limits: Limits = LIMITS
) -> DataFrame:
    """Drop rows whose outlet is a counter."""
    keyed = df.withColumn("_outlet", text.outlet_key(F.col("store_code")))
    listed = counters.select(F.col("pos_code").alias("_outlet")).distinct()
    return join_lookup(keyed, listed, ["_outlet"], "left_anti", size=size, limits=limits).drop("_outlet")


def without_restricted(df: DataFrame, restricted: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Drop restricted products sold outside pharmacies.

    Pharmacy rows get no key, match nothing and therefore stay.
    """
    outside = ~text.one_of(F.col("bucket"), markets.PHARMACY_BUCKETS)
    keyed = df.withColumn("_sku", F.when(outside, F.col("product_sku_code")))
    listed = restricted.select(F.concat(F.lit("S_"), F.col("material")).alias("_sku")).distinct()
    return join_lookup(keyed, listed, ["_sku"], "left_anti", limits=limits).drop("_sku")
