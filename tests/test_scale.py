"""The fact is moved no more often than its steps need."""

from checks import queries, views
from helpers import details_of, plan_of
from pyspark.sql import functions as F
from salesprep import contracts, staging
from salesprep.markets import profile
from salesprep.operators import audit, latest
from salesprep.operators.dedupe import SALES_KEY
from salesprep.plans import publish, region
from salesprep.sources import catalog



def sales_rows(spark, count=40):
    """Sales of three regions; ``count`` rows, of which every second pair is a duplicate but for the address."""
    wanted = {"value_sales": F.col("n") + 1.0, "vol_sales": F.lit(1.0), "address": F.col("id").cast("string")}
    wanted |= {"region": F.element_at(F.array(F.lit("ASIA"), F.lit("EUROPE"), F.lit("N")), (F.col("n") % 3 + 1).cast("int"))}
    wanted |= {"year_month": F.lit("1999/01"), "num_invoices": F.lit(1)}
    rows = spark.range(0, count, 1, 4).withColumn("n", F.col("id").cast("int") - F.col("id").cast("int") % 2)
    return rows.select(*[wanted.get(f.name, F.lit("a")).cast(f.dataType).alias(f.name) for f in contracts.SALES])


def test_customers_join_their_orders_not_the_lines(spark, tmp_path):
    tables = {
        "lineitem": "1L l_orderkey, 2L l_partkey, 3 l_linenumber, 4.0D l_quantity, 5.0D l_extendedprice, timestamp'1999-01-02' l_shipdate",
        "orders": "1L o_orderkey, 7L o_custkey, '1-URGENT' o_orderpriority",
        "customer": "7L c_custkey, 'c' c_name, 9L c_nationkey, 'm' c_mktsegment",
        "part": "2L p_partkey, 'b' p_brand, 't' p_type, 11 p_size",
        "nation": "9L n_nationkey, 'n' n_name, 4L n_regionkey",
        "region": "4L r_regionkey, 'ASIA' r_name",
    }
    for name, columns in tables.items():
        spark.sql(f"select {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    sales = views.sales(spark, str(tmp_path))
    row = sales.first()
    assert (row.store_code, row.brand, row.category_desc, row.address, row.region) == ("1000341009_C_7", "b", "t", "c", "ASIA")
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    places = {key: next(i for i, line in enumerate(joins) if key in line) for key in ("l_orderkey", "o_custkey", "l_partkey")}
    assert places["l_orderkey"] < places["o_custkey"] and places["l_orderkey"] < places["l_partkey"]


def test_fact_is_shuffled_once_until_it_is_staged(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(region, "stage", lambda df, name, by=(): plans.append(plan_of(df)) or staging.stage(df, name, by))
    staged = region.deduped_sales(sales_rows(spark), audit.Steps())
    assert plans[0].count("Exchange") == 1
    assert staged.count() == 20


def test_dedupe_sorts_by_a_number_first():
    assert SALES_KEY[0] == "value_sales"
    assert set(SALES_KEY) == {"region", "year_month", "value_sales", "vol_sales", "product_sku_code", "store_code", "brand", "city"}


def test_snapshots_are_written_where_the_rows_are(spark, tmp_path):
    queries._write_snapshots(sales_rows(spark).withColumn("snapshot", F.lit("S")), f"{tmp_path}/s")
    assert len(list((tmp_path / "s" / "snapshot=S").glob("part-*"))) == 4


def test_markets_read_the_derived_sales_once(spark, monkeypatch):
    derived, read = [], []
    monkeypatch.setattr(views, "sales", lambda *_: derived.append(1) or sales_rows(spark))
    monkeypatch.setattr(views, "pos", lambda *_: None)
    monkeypatch.setattr(views, "restricted_skus", lambda *_: None)

    def run(profile, sales, lookups, history, extract):
        read.append((profile.name, sales.inputFiles()))
        empty = spark.createDataFrame([], contracts.SALES).toDF(*contracts.HISTORY_NAMES)
        catalog.save_by_region(empty, history, "Region")

    monkeypatch.setattr(publish, "run_region", run)
    queries.published_history(spark, "unused")
    assert len(derived) == 1 and [name for name, _ in read] == ["MY_HEALTH", "INDIA_HEALTH"]
    assert read[0][1] and read[0][1] == read[1][1]


def test_a_region_is_saved_again_from_its_table(spark, monkeypatch):
    saved, save = [], catalog.save_by_region
    monkeypatch.setattr(views, "sales", lambda *_: sales_rows(spark))
    monkeypatch.setattr(catalog, "save_by_region", lambda df, *a, **k: saved.append(df.inputFiles()) or save(df, *a, **k))
    found = queries.sink_partition_by_region(spark, "unused")
    assert not saved[0] and saved[1]
    want = {"ASIA": {"again"}, "N": {"a"}}
    assert {r.region: set(r.rr) for r in found.groupBy("region").agg(F.collect_set("rr").alias("rr")).collect()} == want


def test_older_months_are_ruled_out_where_they_are_read(spark, tmp_path):
    path = f"{tmp_path}/sales"
    rows = [("A", f"1998/{m:02}") for m in range(1, 13)] + [("B", f"1997/{m:02}") for m in (3, 7)] + [("A", None), (None, "1999/01"), ("A", "1998-12")]
    spark.createDataFrame(rows, "region string, year_month string").write.parquet(path)
    kept = latest.keep_last_months(spark.read.parquet(path), 2)
    assert "GreaterThanOrEqual(year_month,1997/03)" in details_of(kept)
    assert sorted(map(tuple, kept.collect())) == [("A", "1998/11"), ("A", "1998/12"), ("B", "1997/03"), ("B", "1997/07")]
    assert latest.keep_last_months(spark.read.parquet(path).where("false"), 2).count() == 0


def test_lines_are_moved_with_their_month_not_their_time(spark, tmp_path):
    columns = {
        "lineitem": "1L l_orderkey, 2L l_partkey, 3 l_linenumber, 4.0D l_quantity, 5.0D l_extendedprice, timestamp'1999-01-02' l_shipdate",
        "orders": "1L o_orderkey, 7L o_custkey, '1-URGENT' o_orderpriority",
        "customer": "7L c_custkey, 'c' c_name, 9L c_nationkey, 'm' c_mktsegment",
        "part": "2L p_partkey, 'b' p_brand, 't' p_type, 11 p_size",
        "nation": "9L n_nationkey, 'n' n_name, 4L n_regionkey",
        "region": "4L r_regionkey, 'ASIA' r_name",
    }
    for name, row in columns.items():
        spark.sql(f"select {row}").write.parquet(f"{tmp_path}/{name}.parquet")
    sales = views.sales(spark, str(tmp_path))
    lines = sales._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "Join Inner" in line and "l_partkey" in line)
    months = [i for i, line in enumerate(lines) if "date_format" in line]
    assert months and min(months) > join
    assert sales.first().year_month == "1999/01"


def test_classes_alone_cost_one_shuffle_of_the_fact(spark, monkeypatch):
    names = []
    monkeypatch.setattr(region, "stage", lambda df, name, by=(): names.append(name) or staging.stage(df, name, by))
    sales = sales_rows(spark)
    pos = spark.createDataFrame([], "pos_code string, pos_desc string, partner_code string, pos_status string, sales_rep_code string, sales_rep_name string")
    lookups = region.Lookups(pos, spark.createDataFrame([], "material string"))
    for extract, staged in ((False, False), (True, True)):
        assert region.prepare_sales(sales, lookups, profile("INDIA_HEALTH"), extract=extract).history.count() == 20
        assert ("store-months" in names) is staged
    rows = sales.withColumn("year_month", F.when(F.col("num_invoices") > 0, F.concat(F.lit("1999/0"), F.col("value_sales") % 7 + 1)))
    rows = rows.withColumn("store_code", F.when(F.col("value_sales") % 5 != 0, F.col("region")))
    direct, by_month = latest.latest_class(rows), latest.class_of(latest.store_months(rows))
    assert plan_of(direct).count("Exchange") == 1
    assert sorted(map(str, direct.collect())) == sorted(map(str, by_month.collect()))


def test_classes_are_sorted_by_a_hash_first(spark):
    for classes in (latest.latest_class(sales_rows(spark)), latest.class_of(latest.store_months(sales_rows(spark)))):
        sorts = [line for line in plan_of(classes).splitlines() if "Sort [" in line]
        assert sorts and all(line.split("Sort [")[1].split(" ASC")[0].endswith("L") for line in sorts)
