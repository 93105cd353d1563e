import dataclasses
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute_force import NAMES, all_regions
from helpers import bag, details_of, plan_of
from salesprep import contracts, staging
from salesprep.markets import profile
from salesprep.operators import audit, filters, latest
from salesprep.operators.lookup import LIMITS, Limits
from salesprep.plans import publish, region
from salesprep.sources import catalog

TINY = Limits(broadcast_rows=0, rows_per_task=15)
POS_FIELDS = contracts.POS_NAMES

MARKETS = {
    "INDIA_HEALTH": profile("INDIA_HEALTH"),
    "MY_HEALTH": profile("MY_HEALTH"),
    "PAKISTAN_HOME": dataclasses.replace(profile("PAKISTAN_HOME"), focus_months=2),
    "INDO_HOME": dataclasses.replace(profile("INDO_HOME"), focus_months=3),
}


def make_rows(seed, count=400):
    """Rows with every awkward value, and one store that holds a third of them."""
    pick = random.Random(seed).choice
    stores = ["D1_C_1", "D2_C_1", "D1_C>1", "D2_C>1", "X", "D1_ZOOM1", "D1_ADJ_2", None, "D1_A_B", "D2_A>B", "D3_7", "D4_8"]
    rows = []
    for i in range(count):
        rows.append(
            dict(
                year_month=pick(["2019/11", "2020/01", "2020/02", "2020/04", "2020/05", "2020/07", None, "x"]),
                city=pick(["c", None]),
                store_code="D1_C_1" if i % 3 == 0 else pick(stores),
                brand=pick(["b1", None]),
                product_sku_code=pick(["S_1", "S_2", "S_3", None]),
                outlet_category_name=pick([" k1\t", "k2", None]),
                category_desc=pick(["d", None]),
                address=pick(["a1", "a2", None]),
                metro=pick(["m", None]),
                region=pick(["N", "N", "01", "S-W 1/é", None, ""]),
                bucket=pick([" Pharmacy ", "WSPharmacy\r\n", "Retail", "Based on last", None]),
                yago=pick(["1,234", "abc", None, "5"]),
                beat_code=pick(["1", None]),
                value_sales=pick([1.0, 2.0, 0.0, -1.0, None]),
                vol_sales=pick([1.0, 3.0, 0.0, None]),
                rr=pick(["9,999,999", "", None]),
                num_invoices=pick([1, None]),
            )
        )
    return rows


def make_pos():
    values = [
        ("C_1", "plain", "P1", "1", "r", "x"),
        ("C_1", "plain", "P2", "1", "r", "x"),
        ("A_B", "plain", "P1", "1", "r", None),
        ("7", "The counter", "P9", "1", "r", "x"),
        ("8", None, "P9", "1", "r", "Counter Desk"),
        ("8", None, "P9", "0", "r", "x"),
        ("ZOOM1", "plain", "P3", "1", "r", "x"),
        ("9", "plain", "P3", "1", "", "x"),
    ]
    return [dict(zip(POS_FIELDS, row, strict=True)) for row in values]


RESTRICTED = [dict(material="1"), dict(material="1"), dict(material="9")]
ROUTE = [dict(store_id=s, sales_rep_id="r") for s in ("P1_C_1", "P1_C>1", "NA_", "NA_ADJ_2", "P3_ZOOM1", "P9_7", "D1_C_1")]


def frame(spark, rows, names):
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def prepare(spark, rows, market, unmatched="literal_na", limits=LIMITS, parts=3):
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], contracts.SALES).repartition(parts)
    lookups = region.Lookups(
        pos=frame(spark, make_pos(), POS_FIELDS),
        restricted=frame(spark, RESTRICTED, ["material"]),
        route=frame(spark, ROUTE, ["store_id", "sales_rep_id"]),
    )
    return region.prepare_sales(sales, lookups, market, unmatched, limits)


def check(spark, rows, market, **options):
    prepared = prepare(spark, rows, market, **options)
    history, extract = all_regions(rows, make_pos(), RESTRICTED, ROUTE, market, options.get("unmatched", "literal_na"))
    assert history and prepared.history.columns == list(contracts.HISTORY_NAMES)
    assert bag(prepared.history) == dict.fromkeys(history, 1)
    if market.focus_months:
        assert extract and prepared.focus_extract.columns == list(contracts.EXTRACT_NAMES)
        assert bag(prepared.focus_extract) == dict.fromkeys(extract, 1)
    return prepared


@pytest.mark.parametrize("market", MARKETS)
def test_against_brute_force(spark, market):
    check(spark, make_rows(1), MARKETS[market])


@pytest.mark.parametrize("market", MARKETS)
def test_large_lookups(spark, no_auto_broadcast, market):
    check(spark, make_rows(2), MARKETS[market], limits=TINY, parts=7)


def test_unmatched_outlets_may_keep_their_store(spark):
    check(spark, make_rows(3), MARKETS["INDIA_HEALTH"], unmatched="keep")


def test_rerun_of_one_region_keeps_the_others(spark):
    database = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, staging.new_path(spark, "database"))
    tables = (f"{database}.previous_data", f"{database}.`6m_extract`")
    rows = make_rows(9)
    lookups = region.Lookups(frame(spark, make_pos(), POS_FIELDS), frame(spark, RESTRICTED, ["material"]))
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], contracts.SALES)
    market = MARKETS["INDIA_HEALTH"]
    publish.run_region(market, sales, lookups, *tables)
    again = [r for r in rows if r["region"] == "N" and r["brand"] == "b1"]
    publish.run_region(market, sales.where("region = 'N' and brand = 'b1'"), lookups, *tables, regions=["N"])
    others = all_regions([r for r in rows if r["region"] != "N"], make_pos(), RESTRICTED, ROUTE, market)
    redone = all_regions(again, make_pos(), RESTRICTED, ROUTE, market)
    names = (contracts.HISTORY_NAMES, contracts.EXTRACT_NAMES)
    for table, columns, kept, new in zip(tables, names, others, redone, strict=True):
        assert bag(spark.table(table).select(*columns)) == dict.fromkeys(kept | new, 1)


def test_region_without_rows_leaves_nothing_behind(spark):
    database = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, staging.new_path(spark, "database"))
    tables = (f"{database}.previous_data", f"{database}.`6m_extract`")
    rows = make_rows(9)
    lookups = region.Lookups(frame(spark, make_pos(), POS_FIELDS), frame(spark, RESTRICTED, ["material"]))
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], contracts.SALES)
    market = MARKETS["INDIA_HEALTH"]
    publish.run_region(market, sales, lookups, *tables)
    counts = publish.run_region(market, sales.where("region <> 'N'"), lookups, *tables, regions=["N"])
    assert counts == dict.fromkeys(("loaded", "cleaned", "unique", "stores", "history", "extract"), {})
    left = {r.Region for r in spark.table(tables[0]).select("Region").distinct().collect()}
    assert "N" not in left and left
    publish.run_region(market, sales.where("region = '01'"), lookups, *tables)
    assert {r.Region for r in spark.table(tables[0]).select("Region").distinct().collect()} == {"01"}


def test_rows_per_region_and_nothing_left_staged(spark):
    database = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, f"{spark.conf.get('spark.checkpoint.dir')}/{database}")
    tables = (f"{database}.previous_data", f"{database}.`6m_extract`")
    rows = make_rows(11)
    lookups = region.Lookups(frame(spark, make_pos(), POS_FIELDS), frame(spark, RESTRICTED, ["material"]))
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], contracts.SALES)
    before = catalog.children(spark, staging.work_folder(spark))
    for limits in (LIMITS, TINY):
        counts = publish.run_region(MARKETS["INDIA_HEALTH"], sales, lookups, *tables, limits=limits)
        assert catalog.children(spark, staging.work_folder(spark)) == before
        loaded = Counter(r["region"] or "" for r in rows)
        assert counts["loaded"] == dict(sorted(loaded.items()))
        assert counts["cleaned"].keys() == {"N", "01", "S-W 1/é"} and counts["unique"].keys() == counts["cleaned"].keys()
        for name, table, column in (("history", tables[0], "Region"), ("extract", tables[1], "V10")):
            assert counts[name] == {r[0]: r[1] for r in spark.table(table).groupBy(column).count().collect()}


def test_history_alone_needs_no_focus_months(spark):
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in make_rows(1)], contracts.SALES)
    lookups = region.Lookups(frame(spark, make_pos(), POS_FIELDS), frame(spark, RESTRICTED, ["material"]))
    prepared = region.prepare_sales(sales, lookups, MARKETS["INDIA_HEALTH"], extract=False)
    assert prepared.focus_extract is None
    history, _ = all_regions(make_rows(1), make_pos(), RESTRICTED, ROUTE, MARKETS["INDIA_HEALTH"])
    assert bag(prepared.history) == dict.fromkeys(history, 1)


def test_one_staged_file_for_a_small_region(spark):
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in make_rows(1)], contracts.SALES).repartition(7)
    steps = audit.Steps()
    staged = region.deduped_sales(sales, steps)
    assert len(staged.inputFiles()) == len(steps.counts()["unique"]) == 3
    months = staged.where("region = 'N'").select("year_month").collect()
    assert months == sorted(months, key=lambda r: (r[0] is not None, r[0]))


def test_few_jobs(spark):
    """Jobs that run while the outputs are prepared; each shuffle of a query is one."""
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in make_rows(1)], contracts.SALES)
    lookups = region.Lookups(frame(spark, make_pos(), POS_FIELDS), frame(spark, RESTRICTED, ["material"]))
    for extract, most in ((False, 14), (True, 17)):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "jobs")
        region.prepare_sales(sales, lookups, MARKETS["INDIA_HEALTH"], extract=extract)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= most


def test_fact_is_hashed_for_the_stores(spark):
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in make_rows(1)], contracts.SALES)
    plan = plan_of(latest.store_months(filters.typed_sales(sales)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_market_without_focus_months(spark):
    prepared = check(spark, make_rows(4), profile("PAKISTAN_HOME"))
    assert prepared.focus_extract is None


def test_all_regions_equal_one_by_one(spark):
    rows = make_rows(5)
    market = MARKETS["PAKISTAN_HOME"]
    together = prepare(spark, rows, market)
    parts = [prepare(spark, [r for r in rows if r["region"] == one], market) for one in ("N", "01", "S-W 1/é")]
    for output in ("history", "focus_extract"):
        alone = sum((bag(getattr(part, output)) for part in parts), bag(getattr(together, output).limit(0)))
        assert bag(getattr(together, output)) == alone


def test_no_rows(spark):
    rows = [dict(r, value_sales=0.0) for r in make_rows(6, 5)]
    prepared = prepare(spark, rows, MARKETS["INDIA_HEALTH"])
    assert prepared.history.count() == 0
    assert prepared.focus_extract.count() == 0


def test_lookups_and_contract_are_required(spark):
    sales = spark.createDataFrame([], contracts.SALES)
    pos = frame(spark, make_pos(), POS_FIELDS)
    with pytest.raises(ValueError, match="restricted"):
        region.prepare_sales(sales, region.Lookups(pos), MARKETS["INDIA_HEALTH"])
    with pytest.raises(ValueError, match="visits"):
        region.prepare_sales(sales, region.Lookups(pos), MARKETS["INDO_HOME"])
    with pytest.raises(ValueError, match="beat_code"):
        region.prepare_sales(sales.drop("beat_code"), region.Lookups(pos), MARKETS["MY_HEALTH"])


def test_text_numbers_are_compared_as_numbers(spark):
    rows = [dict(r, value_sales=1234.0, vol_sales=2.0) for r in make_rows(7, 30)]
    sales = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], contracts.SALES)
    texts = sales.withColumns({"value_sales": F.lit("1,234"), "vol_sales": F.lit("2")})
    lookups = region.Lookups(pos=frame(spark, make_pos(), POS_FIELDS))
    results = [bag(region.prepare_sales(df, lookups, MARKETS["MY_HEALTH"]).history) for df in (sales, texts)]
    assert results[0] and results[0] == results[1]


def test_small_lookups_move_only_merged_stores(spark):
    prepared = prepare(spark, make_rows(8), MARKETS["INDIA_HEALTH"])
    plan = plan_of(prepared.history)
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan
    extract = details_of(prepared.focus_extract)
    assert "PushedFilters: [IsNotNull(year_month), GreaterThanOrEqual(year_month,20" in extract
