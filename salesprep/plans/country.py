"""Country level: load the months of a market, clean, correct partner and area."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep import markets
from salesprep.contracts import RAW_EXTRACT, check_contract
from salesprep.functions import months as month_functions
from salesprep.functions import text
from salesprep.markets import MarketProfile
from salesprep.operators import filters, keep, remap, shape
from salesprep.operators.audit import Steps
from salesprep.operators.lookup import LIMITS, Limits
from salesprep.sources import files, jdbc


def month_bounds(
    profile: MarketProfile, as_of: datetime.date, months: tuple[str, str] | None = None
) -> tuple[Column, Column]:
    """First and last month (``yyyyMM`` columns): the caller's, or the market's rule."""
    rule = profile.window
    if months is not None and not (rule is not None and rule.always):
        return F.lit(months[0]), F.lit(months[1])
    if rule is None:
        raise ValueError(f"{profile.name} has no month rule; give the months")
    day = F.lit(as_of)
    return month_functions.window_start(day, rule), month_functions.window_end(day, rule)


def month_values(
    spark: SparkSession, profile: MarketProfile, as_of: datetime.date, months: tuple[str, str] | None = None
) -> tuple[str, str]:
    """The bounds as text, for readers that need it, such as one JDBC predicate per month."""
    return tuple(spark.range(1).select(*month_bounds(profile, as_of, months)).first())


@dataclass(frozen=True)
class SalesFolder:
    """Where a market's sales files arrive: the newest whose name holds ``pattern`` counts."""

    folder: str
    pattern: str
    sep: str = "|"


@dataclass(frozen=True)
class SalesTable:
    """The table of a market's sales: see ``jdbc.read_months``."""

    url: str
    table: str
    properties: Mapping[str, str]
    month: str = "year_month"
    bucket: str | None = None
    rows_per_task: int = 5_000_000


def read_raw(
    spark: SparkSession,
    profile: MarketProfile,
    as_of: datetime.date,
    folder: SalesFolder | None = None,
    table: SalesTable | None = None,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """Raw sales from the source that the market uses: its newest file, or the months of its table."""
    if profile.file_source:
        if folder is None:
            raise ValueError(f"{profile.name} reads its sales from files")
        return check_contract(files.read_latest(spark, folder.folder, folder.pattern, sep=folder.sep), RAW_EXTRACT)
    if table is None:
        raise ValueError(f"{profile.name} reads its sales from a table")
    bounds = month_values(spark, profile, as_of, months)
    return jdbc.read_months(
        spark, table.url, table.table, dict(table.properties), *bounds, table.month, table.bucket, table.rows_per_task
    )


def extract_sales(
    raw: DataFrame,
    profile: MarketProfile,
    as_of: datetime.date,
    months: tuple[str, str] | None = None,
    distributors: DataFrame | None = None,
    limits: Limits = LIMITS,
    steps: Steps | None = None,
    by: str | None = None,
) -> DataFrame:
    """Raw rows with file headers to cleaned sales with normalised names.

    ``steps`` counts the rows that were loaded (of the wanted months, so that these still reach the scan), by a column or in all.
    """
    if not profile.extract:
        raise ValueError(f"{profile.name} has no extract rules")
    if profile.trim_channel:
        raw = raw.withColumn("Channel Local", text.trim_spaces(F.col("Channel Local")))
    if profile.channel_overrides:
        raw = raw.withColumn(
            "DB Channel",
            text.override_by_code(F.col("DB Channel"), F.col("Distributor Code"), profile.channel_overrides),
        )
    sales = filters.month_window(shape.normalize_names(raw), *month_bounds(profile, as_of, months))
    if steps is not None:
        sales = steps.watch(sales, "loaded", by)
    if profile.distributor_recode:
        sales = sales.withColumn(
            "distributor_code", text.recode(F.col("distributor_code"), *profile.distributor_recode)
        )
    if profile.listed_distributors:
        if distributors is None:
            raise ValueError(f"{profile.name} needs a distributor list")
        sales = keep.listed_distributors(sales, distributors, limits)
    if profile.store_with_distributor:
        sales = sales.withColumn("store_code", F.concat("distributor_code", F.lit("_"), "store_code")).drop(
            "distributor_code", "distributor_name"
        )
    if profile.outlet_rules:
        sales = sales.withColumns(
            {
                "asm": F.upper(text.map_values(F.col("asm"), profile.area_fixes)),
                "outlet_unique_code": text.sentinel_fallback(
                    F.col("outlet_unique_code"), F.col("restated_store_code"), markets.MISSING_CODE
                ),
            }
        ).transform(filters.valid_outlets)
    return sales


def correct_partners(
    sales: DataFrame, pos: DataFrame, area_map: DataFrame, profile: MarketProfile, limits: Limits = LIMITS
) -> DataFrame:
    """Distributor from the POS map, then area of the new distributor; each row once."""
    if not profile.correct_partners:
        raise ValueError(f"the sales of {profile.name} carry no distributor to correct")
    pairs = remap.partner_pairs(filters.active_pos(pos))
    areas = remap.clean_areas(area_map, profile.area_fixes)
    return (
        sales.withColumn("outlet_unique_code", text.strip_token(F.col("outlet_unique_code"), markets.OUTLET_PREFIX))
        .transform(remap.remap_distributor, pairs, limits)
        .transform(remap.remap_area, areas, limits=limits)
        .transform(shape.restore_order, sales.columns)
        .distinct()
    )


def build_area_map(corrected: DataFrame, area_map: DataFrame, profile: MarketProfile) -> DataFrame:
    """One area per partner, from the file where it has one, else from the sales."""
    seen = corrected.select(F.col("distributor_code").alias("partner_code"), F.col("asm").alias("new_area"))
    return remap.merge_area_maps(remap.clean_areas(area_map, profile.area_fixes), seen)
