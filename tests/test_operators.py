import itertools
import random

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan_of
from salesprep import contracts
from salesprep.operators import audit, dedupe, filters, keep, latest, remap, shape

NAMES = contracts.SALES.names


def sales_frame(spark, rows):
    """Sales rows from dictionaries; absent columns are null."""
    return spark.createDataFrame([tuple(row.get(name) for name in NAMES) for row in rows], contracts.SALES)


# -- shape ------------------------------------------------------------------------


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["DB Channel", "Year_Month", "A-b/C"])
    assert shape.normalize_names(df).columns == ["db_channel", "year_month", "a_b_c"]
    assert shape.normalize_names(df, ["X y", "Z", "w"]).columns == ["x_y", "z", "w"]


def test_normalize_names_refuses_collisions(spark):
    with pytest.raises(ValueError, match="a_b"):
        shape.normalize_names(spark.createDataFrame([(1, 2)], ["a b", "A-B"]))


def test_positional_names(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert shape.rename_positional(df, ["V1", "V2"]).columns == ["V1", "V2"]
    with pytest.raises(ValueError):
        shape.rename_positional(df, ["V1"])
    assert shape.take_leading(df, 1).columns == ["a"]
    assert shape.restore_order(df, ["b", "a"]).columns == ["b", "a"]


def test_contract(spark):
    good = spark.createDataFrame([], contracts.SALES).withColumn("more", F.lit(1))
    assert contracts.check_contract(good, contracts.SALES) is good
    with pytest.raises(ValueError, match="brand.*nothing"):
        contracts.check_contract(good.drop("brand"), contracts.SALES)
    with pytest.raises(ValueError, match="num_invoices"):
        contracts.check_contract(good.withColumn("num_invoices", F.lit("1")), contracts.SALES)


def test_sales_by_position(spark):
    row = ["2020/01", "c", "D_1", "b", "S_1", "k", None, "a", "m", "N", "x", "1,2", "9", "1,234.5", "bad", "3", "4"]
    typed = shape.as_sales(spark.createDataFrame([row], ", ".join(f"x{i} string" for i in range(17))))
    assert typed.schema.simpleString() == contracts.SALES.simpleString()
    assert list(typed.first()) == row[:13] + [1234.5, None, "3", 4]
    assert bag(shape.as_sales(typed)) == bag(typed)
    with pytest.raises(ValueError):
        shape.as_sales(typed.withColumn("more", F.lit(1)))


# -- filters ----------------------------------------------------------------------


def test_nan_is_not_positive(spark):
    df = spark.createDataFrame([("NaN", "1"), ("1", "NaN"), ("2", "3"), ("5d", "1")], "value_sales string, vol_sales string")
    assert bag(filters.positive_sales(df)) == {(2.0, 3.0): 1}


def test_positive_sales_compares_numbers(spark):
    df = spark.createDataFrame([("1,234", "2"), ("0", "1"), ("abc", "1"), (None, "1"), ("9", "-1")], "value_sales string, vol_sales string")
    assert bag(filters.positive_sales(df)) == {(1234.0, 2.0): 1}


def test_valid_outlets_drops_nulls(spark):
    rows = [("Distributor", "R1", "O1"), (None, "R2", "O"), ("distributor", None, "O"), ("DISTRIBUTOR", "R", None),
            ("DISTRIBUTOR", "NA", "O"), ("DISTRIBUTOR", "Unknown", "O2"), ("DISTRIBUTOR", "R", "Unknown"), ("Modern", "R", "O")]
    df = spark.createDataFrame(rows, "db_channel string, restated_store_code string, outlet_unique_code string")
    assert bag(filters.valid_outlets(df)) == {rows[0]: 1, rows[5]: 1}


POS = "pos_code string, pos_desc string, partner_code string, pos_status string, sales_rep_code string, sales_rep_name string"


def test_active_pos_and_counters(spark):
    rows = [("1", "a Counter", "P", "1", "r", "x"), ("2", None, "P", "1", "r", "cOUNTER"), ("3", "d", "P", "1", "r", None),
            ("4", "d", "P", "0", "r", "x"), ("5", "d", "P", None, "r", "x"), ("6", "d", "P", "one", "r", "x"),
            ("7", "d", "P", "1", "", "x"), ("8", "d", "P", "1", None, "x"), ("9", "d", None, "1", "r", "x"), (None, "d", "P", "1", "r", "x")]
    active = filters.active_pos(spark.createDataFrame(rows, POS))
    assert sorted(row.pos_code for row in active.collect()) == ["1", "2", "3"]
    assert sorted(row.pos_code for row in filters.counter_outlets(active).collect()) == ["1", "2"]


# -- dedupe -----------------------------------------------------------------------


def test_dedupe_keeps_the_least_address_and_ignores_order(spark):
    rows = [dict(region="N", year_month=m, store_code=s, value_sales=v, vol_sales=1.0, address=a, bucket=b)
            for m, s, v, a, b in itertools.product(["2020/01", None], ["D_1", None], [1.0, 2.0], ["b", "a", None], ["x", None])]
    results = []
    for seed, parts in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(rows)
        results.append(bag(dedupe.dedupe_sales(sales_frame(spark, rows).repartition(parts))))
    assert results[0] == results[1]
    assert sum(results[0].values()) == 8
    address, bucket = NAMES.index("address"), NAMES.index("bucket")
    assert {(row[address], row[bucket]) for row in results[0]} == {(None, None)}


def test_dedupe_is_idempotent(spark):
    rows = [dict(region="N", value_sales=float(i % 3), vol_sales=1.0, address=str(i)) for i in range(9)]
    once = dedupe.dedupe_sales(sales_frame(spark, rows))
    assert bag(dedupe.dedupe_sales(once)) == bag(once)


def test_dedupe_limits_copies_before_the_shuffle(spark):
    rows = [dict(region="N", value_sales=1.0, vol_sales=1.0, address="a")] * 40
    plan = plan_of(dedupe.dedupe_sales(sales_frame(spark, rows)))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_first_per_key_and_area(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", None), ("q", "c"), (None, "d")], "partner_code string, new_area string")
    assert bag(dedupe.first_per_key(df, ["partner_code"], ["new_area"])) == {("p", "a"): 1, ("q", None): 1, (None, "d"): 1}
    assert bag(dedupe.one_area_per_partner(df)) == {("p", "a"): 1, ("q", "c"): 1, (None, "d"): 1}


# -- latest -----------------------------------------------------------------------


def test_latest_class_treats_a_missing_month_as_last(spark):
    rows = [dict(region="N", store_code="a", year_month="2020/05", outlet_category_name="k5", bucket="b5"),
            dict(region="N", store_code="a", year_month=None, outlet_category_name="k0", bucket="b0"),
            dict(region="N", store_code=None, year_month="2020/01", outlet_category_name="k1", bucket="b9"),
            dict(region="N", store_code=None, year_month="2020/02", outlet_category_name="k2", bucket=None),
            dict(region="S", store_code="a", year_month="2020/02", outlet_category_name="k2", bucket="b1"),
            dict(region="S", store_code="a", year_month="2020/02", outlet_category_name="k2", bucket="b2"),
            dict(region="S", store_code="a", year_month="2020/02", outlet_category_name="k1", bucket="b3")]
    df = sales_frame(spark, rows)
    assert bag(latest.latest_class(df)) == {("N", "a", "k0", "b0", 2): 1, ("N", None, "k2", None, 2): 1, ("S", "a", "k2", "b2", 3): 1}
    applied = latest.apply_latest_class(df)
    assert applied.columns == NAMES
    seen = bag(applied.select("region", "store_code", "outlet_category_name", "bucket"))
    assert seen == {("N", "a", "k0", "b0"): 2, ("N", None, "k2", None): 2, ("S", "a", "k2", "b2"): 3}


def test_last_months_per_region(spark):
    rows = [dict(region="N", year_month=m) for m in ("2020/01", "2020/03", "2020/03", "2020/09", None, "bad")]
    rows += [dict(region="S", year_month="2019/12")]
    df = sales_frame(spark, rows)
    assert bag(latest.last_months(df, 2)) == {("N", "2020/03"): 1, ("N", "2020/09"): 1, ("S", "2019/12"): 1}
    kept = bag(latest.keep_last_months(df, 2).select("region", "year_month"))
    assert kept == {("N", "2020/03"): 2, ("N", "2020/09"): 1, ("S", "2019/12"): 1}


def test_active_stores_need_volume_in_recent_months(spark):
    rows = [dict(region="N", store_code=s, year_month=m, vol_sales=v)
            for s, m, v in [("old", "2020/01", 1.0), ("new", "2020/05", 1.0), ("new", "2020/01", 1.0), ("idle", "2020/04", 0.0),
                            ("x", "2020/02", 2.0), ("x", "2020/03", 0.0), ("x", "2020/04", None)]]
    kept = bag(latest.keep_active_stores(sales_frame(spark, rows), count=4).select("store_code"))
    assert kept == {("new",): 2, ("x",): 3}


def test_only_the_last_months_are_grouped_for_active_stores(spark, monkeypatch):
    grouped, whole = [], latest.monthly_volume
    monkeypatch.setattr(latest, "monthly_volume", lambda df: grouped.append(bag(df.select("year_month"))) or whole(df))
    rows = [dict(region="N", store_code=f"s{m}", year_month=f"2020/0{m}", vol_sales=1.0) for m in range(1, 9)]
    kept = bag(latest.keep_active_stores(sales_frame(spark, rows), count=2).select("store_code"))
    assert kept == {("s7",): 1, ("s8",): 1}
    assert grouped == [{("2020/07",): 1, ("2020/08",): 1}]


# -- keep and remap ---------------------------------------------------------------


def test_semi_and_anti_make_up_the_input(spark):
    df = sales_frame(spark, [dict(store_code=s) for s in ("D_1", "D_2>3", "D", None)])
    counters = spark.createDataFrame([("1",), ("2_3",), ("1",)], "pos_code string")
    assert bag(keep.without_counters(df, counters).select("store_code")) == {("D",): 1, (None,): 1}
    none = counters.where("false")
    assert bag(keep.without_counters(df, none)) == bag(df)
    route = spark.createDataFrame([("D_1", "r"), ("D_1", "s")], "store_id string, sales_rep_id string")
    assert bag(keep.route_stores(df, route).select("store_code")) == {("D_1",): 1}


def test_restricted_products_stay_in_pharmacies(spark):
    df = sales_frame(spark, [dict(product_sku_code=p, bucket=b) for p in ("S_1", "S_2", None) for b in ("Pharmacy", "WSPharmacy", "Retail", None)])
    restricted = spark.createDataFrame([("1",)], "material string")
    gone = bag(df.select("product_sku_code", "bucket")) - bag(keep.without_restricted(df, restricted).select("product_sku_code", "bucket"))
    assert gone == {("S_1", "Retail"): 1, ("S_1", None): 1}


def test_store_code_remap(spark):
    df = sales_frame(spark, [dict(store_code=s) for s in ("D_1", "D_2>3", "D_4_5", "D", None)])
    pairs = spark.createDataFrame([("1", "P"), ("1", "Q"), ("2_3", "R")], "pos_code string, partner_code string")
    assert bag(remap.remap_store_code(df, pairs).select("store_code")) == {
        ("P_1",): 1, ("Q_1",): 1, ("R_2>3",): 1, ("NA_4_5",): 1, ("NA_",): 2}
    assert bag(remap.remap_store_code(df, pairs, unmatched="keep").select("store_code")) == {
        ("P_1",): 1, ("Q_1",): 1, ("R_2>3",): 1, ("D_4_5",): 1, ("D",): 1, (None,): 1}
    with pytest.raises(ValueError):
        remap.remap_store_code(df, pairs, unmatched="other")


def test_partner_pairs(spark):
    active = spark.createDataFrame([("1", "Q"), ("1", "P"), ("1", "P"), ("2", "R")], "pos_code string, partner_code string")
    assert bag(remap.partner_pairs(active)) == {("1", "P"): 1, ("1", "Q"): 1, ("2", "R"): 1}
    assert bag(remap.partner_pairs(active, one_partner=True)) == {("1", "P"): 1, ("2", "R"): 1}


def test_distributor_and_area(spark):
    df = spark.createDataFrame([("D1", "1", "a"), ("D2", "2", "b"), ("D3", None, None)], "distributor_code string, outlet_unique_code string, asm string")
    pairs = spark.createDataFrame([("1", "0010"), ("1", "D01")], "pos_code string, partner_code string")
    moved = remap.remap_distributor(df, pairs)
    assert bag(moved) == {("0010", "1", "a"): 1, ("D01", "1", "a"): 1, ("D2", "2", "b"): 1, ("D3", None, None): 1}
    areas = spark.createDataFrame([("0010", "x/y"), ("0010", "X/Z"), ("D3", "q")], "partner_code string, new_area string")
    clean = remap.clean_areas(areas, {"X/Y": "XY"})
    assert bag(clean) == {("0010", "X/Z"): 1, ("D3", "Q"): 1}
    assert bag(remap.remap_area(moved, clean).select("distributor_code", "asm")) == {
        ("0010", "X/Z"): 1, ("D01", "a"): 1, ("D2", "b"): 1, ("D3", "Q"): 1}


def test_area_map_prefers_the_file(spark):
    schema = "partner_code string, new_area string"
    areas = spark.createDataFrame([("p", "z"), ("q", None)], schema)
    seen = spark.createDataFrame([("p", "a"), ("q", "c"), ("q", "b"), ("r", None)], schema)
    assert bag(remap.merge_area_maps(areas, seen)) == {("p", "z"): 1, ("q", "b"): 1}


# -- audit ------------------------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([("N", 1), ("N", 2), ("S", 3)], "region string, x int")
    counts = audit.stage_counts({"all": df, "big": df.where("x > 1")})
    assert bag(counts) == {("all", "N", 2): 1, ("all", "S", 1): 1, ("big", "N", 1): 1, ("big", "S", 1): 1}
    steps = {"all": F.lit(True), "big": F.col("x") > 1}
    assert bag(audit.step_counts(df, steps)) == bag(counts)
    observed, seen = audit.observe_rows(df, "rows")
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 3}


def test_rows_per_region_come_with_another_action(spark):
    rows = [("N", 1)] * 5 + [("S", 2)] * 3 + [(None, 3), ("", 4)]
    df = spark.createDataFrame(rows, "region string, x int").repartition(4)
    steps = audit.Steps()
    small = steps.watch(steps.watch(df, "all").where("x < 3"), "small", None)
    steps.watch(small, "none").where("x > 9").write.format("noop").mode("overwrite").save()
    assert steps.counts() == {"all": {"": 2, "N": 5, "S": 3}, "small": {audit.ALL: 8}, "none": {"N": 5, "S": 3}}
    # more regions than are counted on the way
    many = audit.Steps()
    many.watch(spark.range(50_000).select(F.col("id").alias("region")), "all").write.format("noop").mode("overwrite").save()
    assert many.counts() == {"all": {audit.ALL: 50_000}}
