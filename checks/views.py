"""The given tables in the shape of the library's inputs (see FIXTURES.md)."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesprep.staging import stage

View = Callable[[SparkSession, str], DataFrame]

VIEWS: dict[str, View] = {}
_landed: dict[tuple[str, str], DataFrame] = {}


def ensure_work_folder(spark: SparkSession) -> None:
    """Give a local session that has no ``spark.checkpoint.dir`` a new folder."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()) and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def _view(derive: View) -> View:
    """Derive the view from the given tables, or read it where ``land`` has written it."""

    @wraps(derive)
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        landed = _landed.get((sf_dir, derive.__name__))
        return derive(spark, sf_dir) if landed is None else landed

    VIEWS[derive.__name__] = read
    return read


def land(spark: SparkSession, sf_dir: str) -> None:
    """Write all views to tables of as many files as there are cores, as a market's inputs would lie."""
    ensure_work_folder(spark)
    for name, derive in VIEWS.items():
        df = derive(spark, sf_dir)
        _landed[sf_dir, name] = stage(df.repartition(spark.sparkContext.defaultParallelism), name)


def _text(value: Column) -> Column:
    return value.cast("string")


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM")


def _with_commas(value: Column) -> Column:
    """Whole number with thousands commas; the general formatter is slow, few values need it."""
    whole = F.floor(value).cast("bigint")
    thousands = F.concat((whole / 1000).cast("bigint").cast("string"), F.lit(","), F.lpad((whole % 1000).cast("string"), 3, "0"))
    return (
        F.when(whole.between(0, 999), whole.cast("string"))
        .when(whole.between(1000, 999_999), thousands)
        .otherwise(F.format_number(whole, 0))
    )


def _code(nation: Column) -> Column:
    return _text(F.lit(1000341000) + nation)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_view
def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    # lines are moved twice, and never with what their order's customer brings; nation and region are as small as any;
    # a month packs better than a time
    lines = table(spark, sf_dir, "lineitem").withColumn("year_month", _month(c("l_shipdate"))).join(
        table(spark, sf_dir, "part").select(
            "p_partkey", "p_brand", F.when(c("p_size") % 10 != 0, c("p_type")).alias("category_desc")
        ),
        c("l_partkey") == c("p_partkey"),
    )
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
    joined = (
        lines.join(orders, c("l_orderkey") == c("o_orderkey"))
        .join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey"))
    )
    outlet = (
        F.when(c("o_custkey") % 50 == 0, "ZOOM")
        .when(c("o_custkey") % 50 == 1, "ADJ")
        .when(c("o_custkey") % 10 == 3, "C>")
        .otherwise("C_")
    )
    bucket = (
        F.when(c("o_orderpriority") == "1-URGENT", "Pharmacy")
        .when(c("o_orderpriority") == "2-HIGH", "WSPharmacy")
        .when(c("o_orderpriority") == "3-MEDIUM", "Based on history")
        .otherwise(" Retail ")
    )
    category = F.when(c("o_orderkey") % 3 == 0, c("c_mktsegment")).otherwise("GENERAL")
    copies = F.when(c("l_orderkey") % 20 == 0, F.array(F.lit(""), F.lit("DUP "))).otherwise(F.array(F.lit("")))
    return joined.withColumn("copy", F.explode(copies)).select(
        "year_month",
        c("n_name").alias("city"),
        F.concat(_code(c("c_nationkey")), F.lit("_"), outlet, _text(c("o_custkey"))).alias("store_code"),
        c("p_brand").alias("brand"),
        F.concat(F.lit("S_"), _text(c("p_partkey"))).alias("product_sku_code"),
        F.concat(F.lit(" "), category, F.lit("\t")).alias("outlet_category_name"),
        "category_desc",
        F.concat("copy", "c_name").alias("address"),
        c("n_name").alias("metro"),
        c("r_name").alias("region"),
        bucket.alias("bucket"),
        _with_commas(c("l_extendedprice") * 0.9).alias("yago"),
        _text(c("l_linenumber")).alias("beat_code"),
        c("l_extendedprice").alias("value_sales"),
        F.when(c("l_quantity") == 1, 0.0).otherwise(c("l_quantity")).alias("vol_sales"),
        _with_commas(c("l_extendedprice")).alias("rr"),
        c("l_linenumber").alias("num_invoices"),
    )


@_view
def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    own = _code(F.when(k % 9 == 0, (n + 1) % 25).otherwise(n))
    second = _code((n + 2) % 25)
    partners = F.when(k % 20 == 0, F.array(own, second)).otherwise(F.array(own))
    return (
        table(spark, sf_dir, "customer")
        .where((k % 6 != 0) | (k % 20 == 0))
        .select(
            F.concat(F.when(k % 50 == 0, "ZOOM").when(k % 50 == 1, "ADJ").otherwise("C_"), _text(k)).alias("pos_code"),
            F.concat("c_name", F.when(k % 13 == 0, " Counter").otherwise("")).alias("pos_desc"),
            F.explode(partners).alias("partner_code"),
            F.when(k % 11 == 0, "0").otherwise("1").alias("pos_status"),
            F.when(k % 7 == 1, "").when(k % 7 != 0, F.concat(F.lit("REP"), _text(k))).alias("sales_rep_code"),
            F.when(k % 17 == 0, "COUNTER desk").otherwise("Rep").alias("sales_rep_name"),
        )
    )


@_view
def area_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    area = (
        F.when(n % 3 == 0, "Area_B X/Y")
        .when(n % 3 == 1, F.concat(F.lit("area_"), F.col("n_name")))
        .otherwise("AREA_A-Home")
    )
    nation = table(spark, sf_dir, "nation")
    first = nation.where(n % 4 != 0).select(_code(n).alias("partner_code"), area.alias("new_area"))
    return first.unionByName(
        nation.where(n % 5 == 1).select(_code(n).alias("partner_code"), F.lit("area_second").alias("new_area"))
    )


@_view
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    channel = F.when(k % 4 == 0, "Distributor").when(k % 4 == 1, "DISTRIBUTOR").when(k % 4 == 3, "Modern")
    area = (
        F.when(n % 5 == 0, "AREA_A-Home")
        .when(n % 5 == 1, "AREA_B X/Y")
        .otherwise(F.concat(F.lit("Area_"), F.col("n_name")))
    )
    restated = (
        F.when(k % 13 == 0, "NA").when(k % 17 == 0, "Pareto").when(k % 23 != 0, F.concat(F.lit("R"), _text(k)))
    )
    outlet = F.when(k % 15 == 0, "NA").when(k % 19 == 0, "Unknown").otherwise(F.concat(F.lit("SFC_"), _text(k)))
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == k)
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == n)
        .select(
            F.col("o_orderkey").alias("order_key"),
            _month(F.col("o_orderdate")).alias("year_month"),
            _code(n).alias("distributor_code"),
            F.col("n_name").alias("distributor_name"),
            F.concat(F.lit("S"), _text(k)).alias("store_code"),
            channel.alias("db_channel"),
            F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("channel_local"),
            area.alias("asm"),
            restated.alias("restated_store_code"),
            outlet.alias("outlet_unique_code"),
        )
    )


RAW_HEADERS = (
    "Order Key",
    "Year_Month",
    "Distributor Code",
    "Distributor Name",
    "Store Code",
    "DB Channel",
    "Channel Local",
    "ASM",
    "Restated Store Code",
    "Outlet Unique Code",
)


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract under the headers of the raw file."""
    return extract(spark, sf_dir).toDF(*RAW_HEADERS)


@_view
def dist_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").where(n % 5 != 0).select(_code(n).alias("distributor_code"))


@_view
def restricted_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part").where(F.col("p_partkey") % 40 == 0).select(_text(F.col("p_partkey")).alias("material"))
    )


@_view
def route_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .where(k % 3 != 0)
        .select(
            F.concat(_code(F.col("c_nationkey")), F.lit("_C_"), _text(k)).alias("store_id"),
            F.concat(F.lit("REP"), _text(k % 30)).alias("sales_rep_id"),
        )
    )


@_view
def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order day once, as the run date."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
