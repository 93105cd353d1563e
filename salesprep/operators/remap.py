"""Correct codes from reference maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesprep.functions import text
from salesprep.operators.dedupe import first_per_key, one_area_per_partner
from salesprep.operators.lookup import LIMITS, Limits, join_lookup


def partner_pairs(active: DataFrame, one_partner: bool = False) -> DataFrame:
    """Outlet and partner pairs. An outlet with two partners has two, unless ``one_partner``."""
    if one_partner:
        return active.groupBy("pos_code").agg(F.min("partner_code").alias("partner_code"))
    return active.select("pos_code", "partner_code").distinct()


def remap_distributor(df: DataFrame, pairs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Take the distributor from the POS map; keep the old one for unknown outlets.

    A row is repeated for an outlet with several partners.
    """
    by_outlet = pairs.select(F.col("pos_code").alias("outlet_unique_code"), "partner_code")
    return (
        join_lookup(df, by_outlet, ["outlet_unique_code"], limits=limits)
        .withColumn("distributor_code", F.coalesce("partner_code", "distributor_code"))
        .drop("partner_code")
    )


def clean_areas(area_map: DataFrame, fixes: Mapping[str, str]) -> DataFrame:
    """Upper-cased, corrected areas, one per partner."""
    return one_area_per_partner(
        area_map.select("partner_code", text.map_values(F.upper("new_area"), fixes).alias("new_area"))
    )


def remap_area(df: DataFrame, areas: DataFrame, area: str = "asm", limits: Limits = LIMITS) -> DataFrame:
    """Take the area from the map; keep the old one for distributors without."""
    by_distributor = areas.select(F.col("partner_code").alias("distributor_code"), "new_area")
    return (
        join_lookup(df, by_distributor, ["distributor_code"], limits=limits)
        .withColumn(area, F.coalesce("new_area", area))
        .drop("new_area")
    )


def remap_store_code(
    df: DataFrame, pairs: DataFrame, unmatched: str = "literal_na", limits: Limits = LIMITS
) -> DataFrame:
    """Rebuild the store code from the POS map's partner and the old outlet.

    An unknown outlet gets ``NA`` for its partner, or keeps its code with
    ``unmatched="keep"``. A row is repeated for an outlet with several partners.
    """
    keyed = df.withColumn("_outlet", text.outlet_key(F.col("store_code")))
    by_outlet = pairs.select(F.col("pos_code").alias("_outlet"), "partner_code")
    return (
        join_lookup(keyed, by_outlet, ["_outlet"], limits=limits)
        .withColumn("store_code", rebuilt_store_code(unmatched))
        .drop("_outlet", "partner_code")
    )


def rebuilt_store_code(unmatched: str = "literal_na") -> Column:
    """Column: ``partner_code`` and the outlet of ``store_code``."""
    rebuilt = text.compose_code(F.col("partner_code"), text.outlet_part(F.col("store_code")))
    if unmatched == "keep":
        return F.when(F.col("partner_code").isNull(), F.col("store_code")).otherwise(rebuilt)
    if unmatched != "literal_na":
        raise ValueError(f"unknown choice {unmatched!r}")
    return rebuilt


def merge_area_maps(areas: DataFrame, seen: DataFrame) -> DataFrame:
    """One area per partner: from the map where it has one, else from the data."""
    tagged = areas.withColumn("_priority", F.lit(0)).unionByName(seen.distinct().withColumn("_priority", F.lit(1)))
    return first_per_key(
        tagged.where(F.col("new_area").isNotNull()), ["partner_code"], ["_priority", "new_area"]
    ).drop("_priority")
