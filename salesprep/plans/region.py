"""Region level: sales history and the extract of the recent months, all regions in one job.

Everything that depends on a store alone (its class, its partners, whether it is
a counter, on a route or active) is worked out on one small row per store and
reaches the fact through a single join. The fact itself is shuffled once to
remove duplicates, and once more only when the store table is too large to
broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep import contracts, markets
from salesprep.functions import numbers, text
from salesprep.markets import MarketProfile
from salesprep.operators import filters, keep, latest, remap, shape
from salesprep.operators.audit import Steps, region_columns
from salesprep.operators.dedupe import dedupe_sales
from salesprep.operators.lookup import LIMITS, Limits, fits, join_lookup, join_on, spread_join
from salesprep.staging import Size, scope, size_columns, stage, stage_measured, stage_observed

STORE = ["region", "store_code"]


@dataclass(frozen=True)
class Lookups:
    pos: DataFrame
    restricted: DataFrame | None = None
    route: DataFrame | None = None


@dataclass(frozen=True)
class Prepared:
    """Outputs, and rows per region counted while they were staged: loaded, cleaned, unique, stores."""

    history: DataFrame
    focus_extract: DataFrame | None
    counts: dict[str, dict[str, int]]


def clean_sales(sales: DataFrame) -> DataFrame:
    """Measured, positive sales with trimmed texts; rows without a region belong to none. Narrow."""
    return (
        sales.where(F.col("region") != "")
        .withColumns(
            {
                "bucket": text.trim_whitespace(F.col("bucket")),
                "outlet_category_name": text.trim_whitespace(F.col("outlet_category_name")),
            }
        )
        .transform(filters.positive_sales)
        .transform(filters.measured_sales)
    )


def deduped_sales(sales: DataFrame, steps: Steps) -> DataFrame:
    """Cleaned sales without duplicates, staged by region and in order of month within each file.

    The rows are written where they were deduplicated: each of those tasks, of which AQE makes few for few rows, writes
    a file for each region it holds. Gathering a region's rows first would move the whole fact once more. A later scan
    packs small files of a region into one task, so the outputs need no shuffle of their own to be laid out by region.
    """
    cleaned = steps.watch(clean_sales(steps.watch(sales, "loaded")), "cleaned")
    unique = steps.watch(dedupe_sales(cleaned), "unique")
    return stage(unique.sortWithinPartitions("region", "year_month"), "sales", ["region"])


def mark_focus(
    sales: DataFrame, months: DataFrame, count: int, limits: Limits = LIMITS
) -> tuple[DataFrame, str | None]:
    """Flag the rows of the last of ``months`` (``_in_focus``); also the oldest such month.

    That month goes into the extract as a plain filter, which lets the scan skip
    the row groups of older months.
    """
    wanted = latest.last_months(months, count).withColumn("_focus", F.lit(True))
    oldest = F.min("year_month").alias("oldest")
    focus, values = stage_observed(wanted, "focus-months", *size_columns(wanted.columns), oldest)
    size = Size(values.get("row_count", 0), values.get("byte_count", 0))
    marked = join_lookup(sales, focus, ["region", "year_month"], size=size, limits=limits)
    return marked.withColumn("_in_focus", F.coalesce("_focus", F.lit(False))).drop("_focus"), values.get("oldest")


def outlet_partners(pos: DataFrame) -> DataFrame:
    """Outlet and partner pairs of the active rows, once each, and whether any of their rows is a counter's."""
    active = filters.active_pos(pos)
    return active.groupBy("pos_code", "partner_code").agg(F.max(F.coalesce(filters.is_counter(), F.lit(False))).alias("counter"))


def store_table(
    classes: DataFrame,
    months: DataFrame | None,
    lookups: Lookups,
    profile: MarketProfile,
    steps: Steps,
    unmatched: str = "literal_na",
    limits: Limits = LIMITS,
) -> tuple[DataFrame, Size]:
    """What to do with the rows of each store; stores to be dropped are absent.

    One row per store and partner: its class (see ``latest.latest_class``), its new code, its rows in the sales, and whether
    other stores get the same code (``_merged``). ``months`` (``latest.store_months``) tell a market with active months which sold.
    Pairs and counters are read from one staged table, whose size bounds both.
    """
    partners, size = stage_measured(outlet_partners(lookups.pos), "partners")
    if not fits(size, limits):
        classes = stage(classes, "classes")
    stores = (
        join_lookup(
            classes.withColumn("_outlet", text.outlet_key(F.col("store_code"))),
            partners.select(F.col("pos_code").alias("_outlet"), "partner_code"),
            ["_outlet"],
            size=size,
            limits=limits,
        )
        .withColumns({"_old_code": F.col("store_code"), "store_code": remap.rebuilt_store_code(unmatched)})
        .drop("_outlet", "partner_code")
    )
    if profile.route_stores:
        if lookups.route is None:
            raise ValueError(f"{profile.name} needs the planned visits")
        stores = keep.route_stores(stores, lookups.route, limits)
    if profile.active_months is not None:
        stores = active_only(stage(stores, "stores"), months, profile.active_months, limits)
    stores = keep.without_counters(stores, partners.where("counter"), size, limits)
    stores, values = stage_observed(stores, "stores", *size_columns(stores.columns), region_columns()[1])
    steps.add("stores", values)

    # a flag more for each row; AQE broadcasts the shared codes where they are few
    shared = stores.groupBy(*STORE).agg(F.count(F.lit(1)).alias("_stores")).where(F.col("_stores") > 1)
    flagged = join_on(stores, shared, STORE, "left").select(
        "region",
        F.col("_old_code").alias("store_code"),
        F.col("store_code").alias("_new_code"),
        "latest_category",
        "latest_bucket",
        F.col("_stores").isNotNull().alias("_merged"),
        "_rows",
    )
    # as staged, with a flag in place of the key that is dropped
    size = Size(values.get("row_count", 0), values.get("byte_count", 0) + 5 * values.get("row_count", 0))
    return flagged if fits(size, limits) else stage(flagged, "stores"), size


def active_only(stores: DataFrame, sold: DataFrame, count: int, limits: Limits = LIMITS) -> DataFrame:
    """Stores whose new code sold in the last months, adjustment stores not counted.

    What the stores sold by month meets their new codes in one shuffle, and only the last months go on from there.
    """
    old = ["region", F.col("_old_code").alias("store_code")]
    codes = filters.without_adjustments(stores.select(*old, F.col("store_code").alias("_new_code")), "_new_code")
    sold = join_lookup(
        sold.select(*STORE, "year_month", "vol_sales"),
        codes,
        STORE,
        "inner",
        null_safe=STORE,
        counts=stores.select(*old, "_rows").distinct(),
        limits=limits,
    ).select("region", F.col("_new_code").alias("store_code"), "year_month", "vol_sales")
    return latest.keep_active_stores(stores, sold, count, limits)


def sales_by_store(sales: DataFrame, stores: DataFrame, size: Size, limits: Limits = LIMITS) -> DataFrame:
    """The fact with everything its store decides.

    A small store table is broadcast and nothing is moved. A large one costs a
    shuffle, so the result is staged and both outputs read it.
    """
    small = fits(size, limits)
    wanted = stores.drop("_rows")
    if small:
        joined = join_on(sales, F.broadcast(wanted), STORE, "inner", null_safe=STORE)
    else:
        counts = stores.select(*STORE, "_rows").distinct()
        joined = spread_join(sales, wanted, STORE, "inner", null_safe=STORE, counts=counts, limits=limits)
    joined = joined.withColumns(
        {
            "store_code": F.col("_new_code"),
            "outlet_category_name": F.col("latest_category"),
            "bucket": F.col("latest_bucket"),
        }
    ).drop("_new_code", "latest_category", "latest_bucket")
    return joined if small else stage(joined, "sales-by-store", ["region", "_in_focus", "_merged"])


def distinct_sales(df: DataFrame) -> DataFrame:
    """Each row once.

    Rows are already unique within a store of the input, so equal rows can only
    meet where several stores were merged into one code; only those are shuffled.
    """
    unique = df.where(~F.col("_merged")).drop("_merged")
    return unique.unionByName(df.where("_merged").drop("_merged").distinct())


def prepare_sales(
    sales: DataFrame,
    lookups: Lookups,
    profile: MarketProfile,
    unmatched: str = "literal_na",
    limits: Limits = LIMITS,
    extract: bool = True,
) -> Prepared:
    """Sales history (business names) and focus extract (``V1`` to ``V17``).

    The extract is absent for a market without focus months, or where it is not wanted. What is
    staged on the way is deleted, but for the tables that the outputs read.
    """
    contracts.check_contract(filters.typed_sales(sales), contracts.SALES)
    if profile.restricted_skus and lookups.restricted is None:
        raise ValueError(f"{profile.name} needs the restricted products")
    with scope(sales.sparkSession) as run:
        prepared = _prepared(sales, lookups, profile, unmatched, limits, extract and profile.focus_months is not None)
        run.keep(prepared.history, prepared.focus_extract)
    return prepared


def _prepared(
    sales: DataFrame, lookups: Lookups, profile: MarketProfile, unmatched: str, limits: Limits, extract: bool
) -> Prepared:
    names, steps = contracts.SALES.names, Steps()
    unique = deduped_sales(sales.select(*names), steps)
    # a market that looks at no months needs the fact's classes only
    months = stage(latest.store_months(unique), "store-months") if extract or profile.active_months is not None else None
    classes = latest.latest_class(unique) if months is None else latest.class_of(months)
    stores = store_table(classes, months, lookups, profile, steps, unmatched, limits)
    marked, oldest = unique.withColumn("_in_focus", F.lit(False)), None
    if extract:
        marked, oldest = mark_focus(unique, months, profile.focus_months, limits)
    joined = sales_by_store(marked, *stores, limits)
    if profile.restricted_skus:
        joined = keep.without_restricted(joined, lookups.restricted, limits)
    joined = joined.withColumn(
        "category_desc", text.fill_category(F.col("category_desc"), F.col("value_sales"), markets.OTHER_CATEGORY)
    )

    history = (
        joined.transform(filters.without_adjustments)
        .withColumns({name: numbers.parse_number(F.col(name)) for name in ("yago", "rr")})
        .select(*names, "_merged")
        .transform(distinct_sales)
        .transform(shape.rename_positional, contracts.HISTORY_NAMES)
    )
    focus = None
    if extract:
        focus = (
            joined.where(F.col("_in_focus") & (F.col("year_month") >= F.lit(oldest)))
            .select(*names, "_merged")
            .transform(distinct_sales)
            .transform(shape.rename_positional, contracts.EXTRACT_NAMES)
        )
    return Prepared(history, focus, steps.counts())
