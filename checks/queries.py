"""One query per operator, each over whole tables."""

from __future__ import annotations

import dataclasses
import datetime
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from salesprep import contracts, markets
from salesprep.functions import months, numbers, text
from salesprep.markets import profile
from salesprep.operators import audit, dedupe, filters, keep, latest, remap, shape
from salesprep.plans import country, publish, region
from salesprep.sources import catalog, files
from salesprep.staging import new_path, scope, stage

# The given tables hold no real code or area; these stand for the markets' own.
AREA_FIXES = {"AREA_A-Home": "AREA_A-HOME", "AREA_B X/Y": "AREA_B XY"}
OVERRIDES = {"1000341003": "DISTRIBUTOR", "1000341007": "DISTRIBUTOR"}
AS_OF = datetime.date(1999, 1, 31)
GIVEN_MONTHS = ("199703", "199906")
HEALTH = dataclasses.replace(profile("INDIA_HEALTH"), area_fixes=AREA_FIXES, channel_overrides=OVERRIDES)
SMALL_HEALTH = dataclasses.replace(profile("PAK_HEALTH"), channel_overrides=OVERRIDES)


def _database(spark: SparkSession) -> str:
    name = f"salesprep_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, name, new_path(spark, "database"))
    return name


# -- sources and sinks ------------------------------------------------------------


def scan_csv_pipe(spark, d):
    raw = views.raw_extract(spark, d)
    path = new_path(spark, "raw-extract")
    files.write_csv(raw, path, sep="|")
    return shape.normalize_names(
        contracts.check_contract(files.read_csv(spark, path, raw.schema, sep="|"), contracts.RAW_EXTRACT)
    )


def scan_csv_lookup(spark, d):
    path = new_path(spark, "area-map")
    files.write_csv(views.area_map(spark, d).toDF(*contracts.AREA_FILE.names), path)
    return files.read_lookup(spark, path, contracts.AREA_FILE, contracts.AREA_NAMES)


def scan_csv_strings(spark, d):
    path = new_path(spark, "pos")
    files.write_csv(views.pos(spark, d).toDF(*contracts.POS_FILE.names), path, sep="|")
    return files.read_csv(spark, path, sep="|").toDF(*contracts.POS_NAMES)


def latest_file_rows(spark, d):
    sales = views.sales(spark, d)
    folder = new_path(spark, "yearly")
    named = sales.withColumn("snapshot", F.concat(F.lit("SALES_"), F.substring("year_month", 1, 4)))
    _write_snapshots(named, folder)
    return files.read_latest(spark, folder, "SALES_", sales.schema)


def latest_dated_snapshot(spark, d):
    sales = views.sales(spark, d)
    folder = new_path(spark, "dated")
    named = sales.withColumn(
        "snapshot",
        F.concat(F.lit("SALES_"), F.substring("year_month", 1, 4), F.lit("0101_v"), _text(F.col("num_invoices") % 2)),
    )
    _write_snapshots(named, folder)
    as_of = F.lit(datetime.date(1999, 12, 31))
    return files.read_dated(spark, folder, "SALES_", as_of, sales.schema, sep=",", view=f"v_{uuid.uuid4().hex}")


def _text(column):
    return column.cast("string")


def _write_snapshots(named: DataFrame, folder: str) -> None:
    (
        named.write.partitionBy("snapshot")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def scan_table_where(spark, d):
    table = f"{_database(spark)}.sales"
    catalog.save_by_region(views.sales(spark, d), table)
    return catalog.read_region(spark, table, "ASIA")


def temp_view_roundtrip(spark, d):
    view = f"v_{uuid.uuid4().hex}"
    return catalog.through_view(views.pos(spark, d), view, f"SELECT * FROM {view}")


def sink_overwrite_table(spark, d):
    table = f"{_database(spark)}.sales"
    catalog.save_table(views.pos(spark, d), table)
    catalog.save_table(views.sales(spark, d), table)
    return spark.table(table)


def sink_ctas_copy(spark, d):
    database = _database(spark)
    catalog.save_table(views.extract(spark, d), f"{database}.sales")
    catalog.copy_table(spark, f"{database}.sales", f"{database}.sales_raw_data")
    return spark.table(f"{database}.sales_raw_data")


def sink_partition_by_region(spark, d):
    table = f"{_database(spark)}.sales"
    sales = views.sales(spark, d)
    catalog.save_by_region(sales, table)
    again = catalog.read_region(spark, table, "ASIA").select(*sales.columns).withColumn("rr", F.lit("again"))
    catalog.save_by_region(again, table, regions=["ASIA", "EUROPE"])
    return spark.table(table).select(*sales.columns)


# -- names and columns ------------------------------------------------------------


def normalize_names(spark, d):
    return shape.normalize_names(views.raw_extract(spark, d))


def rename_columns(spark, d):
    return views.extract(spark, d).withColumnsRenamed({"distributor_code": "DB", "outlet_unique_code": "POSCode"})


def rename_positional(spark, d):
    numbered = shape.rename_positional(views.sales(spark, d), contracts.EXTRACT_NAMES)
    return shape.rename_positional(numbered, contracts.HISTORY_NAMES)


def drop_columns(spark, d):
    return views.sales(spark, d).drop("metro", "num_invoices", "yago")


def select_columns(spark, d):
    return views.sales(spark, d).select("year_month", "store_code", "outlet_category_name", "bucket")


def restore_column_order(spark, d):
    sales = views.extract(spark, d)
    pairs = remap.partner_pairs(filters.active_pos(views.pos(spark, d)))
    return remap.remap_distributor(sales, pairs).transform(shape.restore_order, sales.columns)


def take_leading_columns(spark, d):
    sales = views.sales(spark, d)
    wider = sales.withColumns(
        {"v18": text.distributor_part(F.col("store_code")), "v19": text.outlet_part(F.col("store_code"))}
    )
    return shape.take_leading(wider, 17)


# -- filters ----------------------------------------------------------------------


def filter_month_window(spark, d):
    return filters.month_window(views.extract(spark, d), *country.month_bounds(HEALTH, AS_OF))


def filter_valid_outlets(spark, d):
    return filters.valid_outlets(views.extract(spark, d))


def filter_active_pos(spark, d):
    return filters.active_pos(views.pos(spark, d))


def filter_positive_sales(spark, d):
    return filters.positive_sales(views.sales(spark, d))


def filter_not_contains(spark, d):
    return filters.measured_sales(views.sales(spark, d))


def filter_not_regex(spark, d):
    return filters.without_adjustments(views.sales(spark, d))


def counter_outlets(spark, d):
    return filters.counter_outlets(views.pos(spark, d))


# -- scalar functions -------------------------------------------------------------


def override_by_code(spark, d):
    return views.extract(spark, d).withColumn(
        "db_channel", text.override_by_code(F.col("db_channel"), F.col("distributor_code"), OVERRIDES)
    )


def map_values(spark, d):
    return views.extract(spark, d).withColumn("asm", F.upper(text.map_values(F.col("asm"), AREA_FIXES)))


def sentinel_fallback(spark, d):
    return views.extract(spark, d).withColumn(
        "outlet_unique_code",
        text.sentinel_fallback(F.col("outlet_unique_code"), F.col("restated_store_code"), markets.MISSING_CODE),
    )


def fill_null_category(spark, d):
    return views.sales(spark, d).withColumn(
        "category_desc", text.fill_category(F.col("category_desc"), F.col("value_sales"), markets.OTHER_CATEGORY)
    )


def regex_recode(spark, d):
    return views.extract(spark, d).withColumn("distributor_code", text.recode(F.col("distributor_code"), "341", "161"))


def strip_token(spark, d):
    return views.extract(spark, d).withColumn(
        "outlet_unique_code", text.strip_token(F.col("outlet_unique_code"), markets.OUTLET_PREFIX)
    )


def replace_char(spark, d):
    return views.sales(spark, d).withColumn("outlet", text.outlet_key(F.col("store_code")))


def compose_store_code(spark, d):
    return views.pos(spark, d).withColumn("store_code", text.compose_code(F.col("partner_code"), F.col("pos_code")))


def split_store_code(spark, d):
    return views.sales(spark, d).withColumns(
        {"v18": text.distributor_part(F.col("store_code")), "v19": text.outlet_part(F.col("store_code"))}
    )


def trim_spaces(spark, d):
    return views.extract(spark, d).withColumn("channel_local", text.trim_spaces(F.col("channel_local")))


def trim_whitespace(spark, d):
    return views.sales(spark, d).withColumns(
        {
            "bucket": text.trim_whitespace(F.col("bucket")),
            "outlet_category_name": text.trim_whitespace(F.col("outlet_category_name")),
        }
    )


def sanitize_value(spark, d):
    return views.sales(spark, d).withColumn("region", text.sanitize(F.col("region")))


def parse_number(spark, d):
    return views.sales(spark, d).withColumns(
        {"yago": numbers.parse_number(F.col("yago")), "rr": numbers.parse_number(F.col("rr"))}
    )


def month_to_date(spark, d):
    return views.sales(spark, d).withColumn("month_start", months.month_to_date(F.col("year_month")))


def date_to_month(spark, d):
    return views.order_days(spark, d).withColumns(
        {"year_month": months.date_to_month(F.col("as_of")), "month_code": months.date_to_month(F.col("as_of"), "yyyyMM")}
    )


def snapshot_tag(spark, d):
    return views.order_days(spark, d).withColumns(
        {"month_end": months.is_month_end(F.col("as_of")), "tag": months.snapshot_tag(F.col("as_of"))}
    )


def _windows(spark, d):
    day = F.col("as_of")
    rows = [
        F.struct(
            F.lit(market.name).alias("market"),
            months.window_start(day, market.window).alias("start_month"),
            months.window_end(day, market.window).alias("end_month"),
        )
        for market in markets.PROFILES.values()
        if market.window is not None
    ]
    return views.order_days(spark, d).select(day, F.inline(F.array(*rows)))


def market_windows(spark, d):
    return _windows(spark, d)


def month_sequence(spark, d):
    listed = months.month_sequence(F.col("start_month"), F.col("end_month"))
    return _windows(spark, d).select("as_of", "market", F.explode_outer(listed).alias("year_month"))


# -- joins ------------------------------------------------------------------------


def _active(spark, d):
    return filters.active_pos(views.pos(spark, d))


def remap_distributor(spark, d):
    sales = views.extract(spark, d).withColumn(
        "outlet_unique_code", text.strip_token(F.col("outlet_unique_code"), markets.OUTLET_PREFIX)
    )
    return remap.remap_distributor(sales, remap.partner_pairs(_active(spark, d)))


def remap_area(spark, d):
    return remap.remap_area(views.extract(spark, d), remap.clean_areas(views.area_map(spark, d), AREA_FIXES))


def latest_class_per_store(spark, d):
    return latest.apply_latest_class(views.sales(spark, d))


def remap_store_code(spark, d):
    return remap.remap_store_code(views.sales(spark, d), remap.partner_pairs(_active(spark, d)))


def semi_distributors(spark, d):
    return keep.listed_distributors(views.extract(spark, d), views.dist_list(spark, d))


def semi_route_stores(spark, d):
    return keep.route_stores(views.sales(spark, d), views.route_stores(spark, d))


def semi_active_stores(spark, d):
    return latest.keep_active_stores(views.sales(spark, d), count=4)


def anti_counter_outlets(spark, d):
    return keep.without_counters(views.sales(spark, d), filters.counter_outlets(_active(spark, d)))


def anti_restricted_skus(spark, d):
    return keep.without_restricted(views.sales(spark, d), views.restricted_skus(spark, d))


# -- distinct, dedupe, top months ---------------------------------------------------


def distinct_rows(spark, d):
    sales = views.sales(spark, d)
    return sales.unionByName(sales.where(F.col("num_invoices") == 1)).distinct()


def distinct_pairs(spark, d):
    return remap.partner_pairs(views.pos(spark, d))


def distinct_values(spark, d):
    return views.sales(spark, d).select("store_code").distinct()


def dedupe_by_key(spark, d):
    return dedupe.first_per_key(views.area_map(spark, d), ["partner_code"], ["new_area"])


def dedupe_sales(spark, d):
    return dedupe.dedupe_sales(views.sales(spark, d))


def precedence_union_map(spark, d):
    seen = views.extract(spark, d).select(
        F.col("distributor_code").alias("partner_code"), F.col("asm").alias("new_area")
    )
    return remap.merge_area_maps(remap.clean_areas(views.area_map(spark, d), AREA_FIXES), seen)


def stage_row_counts(spark, d):
    sales = filters.typed_sales(views.sales(spark, d))
    steps = {"loaded": F.lit(True), "positive": filters.is_positive(), "measured": filters.is_measured()}
    unique = dedupe.dedupe_sales(filters.measured_sales(filters.positive_sales(sales)))
    return audit.step_counts(sales, steps).unionByName(audit.stage_counts({"unique": unique}))


def focus_months_extract(spark, d):
    return latest.keep_last_months(views.sales(spark, d), 6)


def months_present(spark, d):
    return latest.months_present(views.sales(spark, d)).orderBy("region", "year_month")


# -- whole jobs -------------------------------------------------------------------


def country_extract(spark, d):
    return country.extract_sales(views.raw_extract(spark, d), HEALTH, AS_OF)


def country_extract_channel(spark, d):
    return country.extract_sales(views.raw_extract(spark, d), SMALL_HEALTH, AS_OF)


def country_extract_listed(spark, d):
    return country.extract_sales(
        views.raw_extract(spark, d),
        profile("PAKISTAN_HOME"),
        AS_OF,
        months=GIVEN_MONTHS,
        distributors=views.dist_list(spark, d).select(
            text.recode(F.col("distributor_code"), "341", "161").alias("distributor_code")
        ),
    )


def country_extract_open_month(spark, d):
    return country.extract_sales(
        views.raw_extract(spark, d), profile("INDO_HOME"), AS_OF, distributors=views.dist_list(spark, d)
    )


def corrected_sales(spark, d):
    return country.correct_partners(
        country_extract(spark, d), views.pos(spark, d), views.area_map(spark, d), HEALTH
    )


def _published_country(spark, d):
    database = _database(spark)
    publish.publish_country(
        spark,
        corrected_sales(spark, d),
        views.area_map(spark, d),
        HEALTH,
        f"{database}.sales",
        f"{database}.area_map",
        f"{database}.raw_data",
    )
    return database


def built_area_map(spark, d):
    return spark.table(f"{_published_country(spark, d)}.area_map")


def _prepared(spark, d, market, extract=True):
    lookups = region.Lookups(
        pos=views.pos(spark, d), restricted=views.restricted_skus(spark, d), route=views.route_stores(spark, d)
    )
    return region.prepare_sales(views.sales(spark, d), lookups, market, extract=extract)


def sales_history(spark, d):
    return _prepared(spark, d, profile("INDIA_HEALTH"), extract=False).history


def sales_history_active_stores(spark, d):
    return _prepared(spark, d, profile("PAKISTAN_HOME"), extract=False).history


def sales_history_route_stores(spark, d):
    return _prepared(spark, d, profile("INDO_HOME"), extract=False).history


def focus_extract(spark, d):
    return _prepared(spark, d, profile("INDIA_HEALTH")).focus_extract


def published_history(spark, d):
    database = _database(spark)
    tables = f"{database}.history", f"{database}.focus_extract"
    lookups = region.Lookups(pos=views.pos(spark, d), restricted=views.restricted_skus(spark, d))
    with scope(spark):
        sales = stage(views.sales(spark, d), "sales")
        for name in ("MY_HEALTH", "INDIA_HEALTH"):
            publish.run_region(profile(name), sales, lookups, *tables)
    return spark.table(tables[0]).select(*contracts.HISTORY_NAMES)


def focus_extract_five_months(spark, d):
    return _prepared(spark, d, profile("MY_HEALTH")).focus_extract


def focus_extract_active_stores(spark, d):
    return _prepared(spark, d, dataclasses.replace(profile("PAKISTAN_HOME"), focus_months=6)).focus_extract


def _with_work_folder(query):
    """The library wants ``spark.checkpoint.dir`` set; a local session without it gets a new folder."""

    @functools.wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        views.ensure_work_folder(spark)
        return query(spark, d)

    return run


QUERIES = {
    query.__name__: _with_work_folder(query)
    for query in (
        scan_csv_pipe,
        scan_csv_lookup,
        scan_csv_strings,
        latest_file_rows,
        latest_dated_snapshot,
        scan_table_where,
        temp_view_roundtrip,
        sink_overwrite_table,
        sink_ctas_copy,
        sink_partition_by_region,
        normalize_names,
        rename_columns,
        rename_positional,
        drop_columns,
        select_columns,
        restore_column_order,
        take_leading_columns,
        filter_month_window,
        filter_valid_outlets,
        filter_active_pos,
        filter_positive_sales,
        filter_not_contains,
        filter_not_regex,
        counter_outlets,
        override_by_code,
        map_values,
        sentinel_fallback,
        fill_null_category,
        regex_recode,
        strip_token,
        replace_char,
        compose_store_code,
        split_store_code,
        trim_spaces,
        trim_whitespace,
        sanitize_value,
        parse_number,
        month_to_date,
        date_to_month,
        snapshot_tag,
        market_windows,
        month_sequence,
        remap_distributor,
        remap_area,
        latest_class_per_store,
        remap_store_code,
        semi_distributors,
        semi_route_stores,
        semi_active_stores,
        anti_counter_outlets,
        anti_restricted_skus,
        distinct_rows,
        distinct_pairs,
        distinct_values,
        dedupe_by_key,
        dedupe_sales,
        precedence_union_map,
        stage_row_counts,
        focus_months_extract,
        months_present,
        country_extract,
        country_extract_channel,
        country_extract_listed,
        country_extract_open_month,
        corrected_sales,
        built_area_map,
        sales_history,
        sales_history_active_stores,
        sales_history_route_stores,
        published_history,
        focus_extract,
        focus_extract_five_months,
        focus_extract_active_stores,
    )
}
