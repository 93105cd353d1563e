"""From inputs to catalog tables."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.markets import MarketProfile
from salesprep.operators.audit import Steps
from salesprep.operators.lookup import LIMITS, Limits
from salesprep.operators.shape import as_sales
from salesprep.plans.country import build_area_map, correct_partners, extract_sales
from salesprep.plans.region import Lookups, Prepared, prepare_sales
from salesprep.sources import catalog
from salesprep.staging import scope


def publish_country(
    spark: SparkSession,
    corrected: DataFrame,
    area_map: DataFrame,
    profile: MarketProfile,
    sales_table: str,
    area_table: str,
    raw_table: str | None = None,
) -> None:
    """Corrected sales, the area map, and a raw copy (``raw_table``) where the market needs one.

    The area map is built from the written sales, so they are computed once.
    """
    if profile.keep_raw_copy and raw_table is None:
        raise ValueError(f"{profile.name} needs a name for the raw copy")
    catalog.save_table(corrected, sales_table)
    catalog.save_table(build_area_map(spark.table(sales_table), area_map, profile), area_table)
    if profile.keep_raw_copy:
        catalog.copy_table(spark, sales_table, raw_table)


def publish_region(
    prepared: Prepared, history_table: str, extract_table: str, regions: Sequence[str] | None = None
) -> dict[str, dict[str, int]]:
    """History and extract, one partition per region; with ``regions`` the others stay as they are. Returns the rows written per region."""
    steps = Steps()
    outputs = {"history": (prepared.history, history_table, "Region"), "extract": (prepared.focus_extract, extract_table, "V10")}
    for name, (rows, table, column) in outputs.items():
        if rows is not None:
            catalog.save_by_region(steps.watch(rows, name, column), table, column, gather=False, regions=regions)
    return steps.counts()


def run_country(
    spark: SparkSession,
    profile: MarketProfile,
    as_of: datetime.date,
    raw: DataFrame,
    sales_table: str,
    area_table: str,
    pos: DataFrame | None = None,
    area_map: DataFrame | None = None,
    distributors: DataFrame | None = None,
    months: tuple[str, str] | None = None,
    limits: Limits = LIMITS,
    raw_table: str | None = None,
    by: str | None = None,
) -> dict[str, dict[str, int]]:
    """Extract, correct and publish a market. A market without partner correction has sales only.

    Returns the rows of the steps (loaded, extracted, corrected), by a column of the sales or in all (``audit.ALL``), counted
    while they run. What is staged on the way is deleted.
    """
    steps = Steps()
    with scope(spark):
        sales = extract_sales(raw, profile, as_of, months, distributors, limits, steps, by)
        sales = steps.watch(sales, "extracted", by)
        if not profile.correct_partners:
            catalog.save_table(sales, sales_table)
            return steps.counts()
        if pos is None or area_map is None:
            raise ValueError(f"{profile.name} needs the POS map and the area map")
        corrected = steps.watch(correct_partners(sales, pos, area_map, profile, limits), "corrected", by)
        publish_country(spark, corrected, area_map, profile, sales_table, area_table, raw_table)
        return steps.counts()


def run_region(
    profile: MarketProfile,
    sales: DataFrame,
    lookups: Lookups,
    history_table: str,
    extract_table: str,
    unmatched: str = "literal_na",
    limits: Limits = LIMITS,
    regions: Sequence[str] | None = None,
) -> dict[str, dict[str, int]]:
    """Prepare and publish ``sales`` (the 17 columns, by position): all regions, or only ``regions``.

    Returns the rows of the steps per region: loaded, cleaned, unique, the stores that are kept, and the rows of both outputs.
    Without ``regions`` both tables are replaced, so a region that is gone leaves nothing behind. Only the outputs are left of the run.
    """
    rows = as_sales(sales)
    rows = rows if regions is None else rows.where(F.col("region").isin(*regions))
    with scope(sales.sparkSession):
        prepared = prepare_sales(rows, lookups, profile, unmatched, limits)
        return prepared.counts | publish_region(prepared, history_table, extract_table, regions)
