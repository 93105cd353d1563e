import datetime
import uuid

import pytest

from helpers import bag, details_of
from salesprep import staging
from salesprep.markets import profile
from salesprep.operators.lookup import Limits
from salesprep.plans import country, publish
from salesprep.sources import catalog

AS_OF = datetime.date(2020, 2, 29)
HEADERS = ["Year_Month", "Distributor Code", "Distributor Name", "Store Code", "DB Channel", "Channel Local", "ASM",
           "Restated Store Code", "Outlet Unique Code", "LOB"]


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in HEADERS))


def row(month="2020/01", distributor="D1", name="n", store="s", channel="Distributor", local=" l ", asm="a",
        restated="R1", outlet="SFO1", lob="x"):
    return (month, distributor, name, store, channel, local, asm, restated, outlet, lob)


def test_outlet_rules(spark):
    rows = [
        row(asm="ASM_CHENNAI-Home"),
        row(asm="ASM_HP JK/CHD", outlet="NA", restated="R2"),
        row(asm="asm_x", channel=None, distributor="1000061620"),
        row(channel=None),
        row(restated=None),
        row(outlet="Unknown"),
        row(outlet="NA", restated="NA"),
        row(month="2020/02"),
        row(month="2018/01"),
        row(month="2017/12"),
        row(month=None),
    ]
    out = country.extract_sales(raw_frame(spark, rows), profile("INDIA_HEALTH"), AS_OF, months=("201001", "203001"))
    assert out.columns == ["year_month", "distributor_code", "distributor_name", "store_code", "db_channel", "channel_local",
                           "asm", "restated_store_code", "outlet_unique_code", "lob"]
    assert bag(out.select("year_month", "asm", "db_channel", "outlet_unique_code")) == {
        ("2020/01", "ASM_CHENNAI-HOME", "Distributor", "SFO1"): 1,
        ("2020/01", "ASM_HP JKCHD", "Distributor", "R2"): 1,
        ("2020/01", "ASM_X", "DISTRIBUTOR", "SFO1"): 1,
        ("2018/01", "A", "Distributor", "SFO1"): 1,
    }


def test_channel_is_trimmed(spark):
    out = country.extract_sales(raw_frame(spark, [row(), row(channel="\tx", local="\ty ")]), profile("PAK_HEALTH"), AS_OF)
    assert bag(out.select("channel_local", "asm")) == {("l", "a"): 1, ("\ty", "a"): 1}


def test_listed_distributors(spark):
    rows = [row(distributor="3411"), row(distributor="D2"), row(distributor=None), row(month="2020/02", distributor="3411"),
            row(month="2016/12", distributor="3411")]
    listed = spark.createDataFrame([("1611",), ("1611",)], "distributor_code string")
    out = country.extract_sales(raw_frame(spark, rows), profile("PAKISTAN_HOME"), AS_OF, distributors=listed)
    assert "distributor_code" not in out.columns and "distributor_name" not in out.columns
    assert bag(out.select("year_month", "store_code")) == {("2020/01", "1611_s"): 1, ("2020/02", "1611_s"): 1}
    given = country.extract_sales(raw_frame(spark, rows), profile("PAKISTAN_HOME"), AS_OF, ("201601", "201612"), listed)
    assert bag(given.select("year_month")) == {("2016/12",): 1}
    with pytest.raises(ValueError, match="list"):
        country.extract_sales(raw_frame(spark, rows), profile("INDO_HOME"), AS_OF)


def test_markets_without_rules_raise(spark):
    raw = raw_frame(spark, [row()])
    with pytest.raises(ValueError):
        country.extract_sales(raw, profile("INDIA_HOME"), AS_OF)
    with pytest.raises(ValueError):
        country.month_bounds(profile("INDO_HEALTH"), AS_OF)
    with pytest.raises(ValueError):
        country.correct_partners(raw, raw, raw, profile("PAKISTAN_HOME"))


def test_month_values(spark):
    assert country.month_values(spark, profile("INDIA_HEALTH"), AS_OF, ("201001", "201002")) == ("201801", "202001")
    assert country.month_values(spark, profile("INDO_HOME"), AS_OF) == ("201612", "202002")
    assert country.month_values(spark, profile("INDO_HOME"), AS_OF, ("201001", "201002")) == ("201001", "201002")


def lookups(spark):
    pos = spark.createDataFrame(
        [("O1", "d", "P1", "1", "r", "n"), ("O1", "d", "P2", "1", "r", "n"), ("O2", "d", "P3", "0", "r", "n")],
        "pos_code string, pos_desc string, partner_code string, pos_status string, sales_rep_code string, sales_rep_name string",
    )
    areas = spark.createDataFrame([("P1", "asm_hp jk/chd"), ("P1", "b"), ("D2", "x"), ("P9", None)], "partner_code string, new_area string")
    return pos, areas


SALES = "distributor_code string, asm string, outlet_unique_code string, v int"


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, rows_per_task=2)])
def test_corrections(spark, no_auto_broadcast, limits):
    rows = [("D1", "a", "SFO1", 1)] * 5 + [("D2", "a", "O2", 1), ("D3", "a", None, 1), (None, None, "O3", 1)]
    pos, areas = lookups(spark)
    out = country.correct_partners(spark.createDataFrame(rows, SALES), pos, areas, profile("INDIA_HEALTH"), limits)
    assert out.columns == ["distributor_code", "asm", "outlet_unique_code", "v"]
    assert bag(out) == {
        ("P1", "ASM_HP JKCHD", "O1", 1): 1,
        ("P2", "a", "O1", 1): 1,
        ("D2", "X", "O2", 1): 1,
        ("D3", "a", None, 1): 1,
        (None, None, "O3", 1): 1,
    }
    assert bag(country.build_area_map(out, areas, profile("INDIA_HEALTH"))) == {
        ("P1", "ASM_HP JKCHD"): 1, ("P2", "a"): 1, ("D2", "X"): 1, ("D3", "a"): 1}


def test_raw_text_is_parsed_once(spark, no_auto_broadcast):
    """With both maps too large to broadcast, every raw row is computed once."""
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    pos, areas = lookups(spark)
    raw = raw_frame(spark, [row(outlet=f"SFO{i % 3}", distributor=f"D{i % 2}", lob=str(i)) for i in range(50)]).repartition(3)
    counted = raw.mapInArrow(count, raw.schema)
    limits = Limits(broadcast_rows=0, rows_per_task=5)
    market = profile("INDIA_HEALTH")
    out = country.correct_partners(country.extract_sales(counted, market, AS_OF), pos, areas, market, limits)
    assert bag(out) == bag(country.correct_partners(country.extract_sales(raw, market, AS_OF), pos, areas, market))
    assert rows.value == 50


def test_market_chooses_its_source(spark, tmp_path, monkeypatch):
    for day, store in (("20200101", "old"), ("20200201", "new")):
        (tmp_path / f"SALES_{day}.csv").write_text("|".join(HEADERS) + "\n" + "|".join(row(store=store)) + "\n")
    folder = country.SalesFolder(str(tmp_path), "SALES_")
    found = country.read_raw(spark, profile("INDIA_HEALTH"), AS_OF, folder)
    assert [r["Store Code"] for r in found.collect()] == ["new"]
    calls = []
    monkeypatch.setattr(country.jdbc, "read_months", lambda *given: calls.append(given[1:]))
    table = country.SalesTable("jdbc:x", "sales", {"user": "u"}, bucket="MOD(n, {buckets})")
    country.read_raw(spark, profile("INDO_HOME"), AS_OF, folder, table)
    assert calls == [("jdbc:x", "sales", {"user": "u"}, "201612", "202002", "year_month", "MOD(n, {buckets})", 5_000_000)]
    for market, given in (("INDIA_HEALTH", {"table": table}), ("INDO_HOME", {"folder": folder})):
        with pytest.raises(ValueError, match="reads its sales"):
            country.read_raw(spark, profile(market), AS_OF, **given)


def test_publishing(spark):
    database = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, staging.new_path(spark, "database"))
    corrected = spark.createDataFrame([("P1", "q", "O1", 1)], SALES)
    _, areas = lookups(spark)
    tables = (f"{database}.sales", f"{database}.areas")
    for market, copied in ((profile("INDO_HOME"), False), (profile("INDIA_HEALTH"), True)):
        publish.publish_country(spark, corrected, areas, market, *tables, f"{database}.`6m_raw`")
        assert bag(spark.table(tables[0])) == bag(corrected)
        assert bag(spark.table(tables[1])) == {("P1", "ASM_HP JKCHD"): 1, ("D2", "X"): 1}
        assert spark.catalog.tableExists(f"{database}.`6m_raw`") == copied
    with pytest.raises(ValueError, match="raw copy"):
        publish.publish_country(spark, corrected, areas, profile("INDIA_HEALTH"), *tables)


def test_country_run(spark):
    database = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, staging.new_path(spark, "database"))
    tables = (f"{database}.sales", f"{database}.areas")
    pos, areas = lookups(spark)
    raw = raw_frame(spark, [row(), row(distributor="D2", outlet="SFO2"), row()])
    counts = publish.run_country(
        spark, profile("INDIA_HEALTH"), AS_OF, raw, *tables, pos=pos, area_map=areas, raw_table=f"{database}.raw", by="distributor_code"
    )
    assert counts == {"loaded": {"D1": 2, "D2": 1}, "extracted": {"D1": 2, "D2": 1}, "corrected": {"D2": 1, "P1": 1, "P2": 1}}
    assert bag(spark.table(tables[0]).select("distributor_code", "asm", "outlet_unique_code")) == {
        ("P1", "ASM_HP JKCHD", "O1"): 1, ("P2", "A", "O1"): 1, ("D2", "X", "O2"): 1}
    with pytest.raises(ValueError, match="POS"):
        publish.run_country(spark, profile("INDIA_HEALTH"), AS_OF, raw, *tables)
    listed = spark.createDataFrame([("D2",)], "distributor_code string")
    counts = publish.run_country(spark, profile("PAKISTAN_HOME"), AS_OF, raw, *tables, distributors=listed)
    assert counts == {"loaded": {"*": 3}, "extracted": {"*": 1}}
    assert bag(spark.table(tables[0]).select("store_code")) == {("D2_s",): 1}


def test_month_window_reaches_the_scan(spark):
    path = staging.new_path(spark, "raw")
    raw_frame(spark, [row()]).write.parquet(path)
    plan = details_of(country.extract_sales(spark.read.parquet(path), profile("INDIA_HEALTH"), AS_OF))
    assert "GreaterThanOrEqual(Year_Month,2018/01), LessThanOrEqual(Year_Month,2020/01)" in plan
