import datetime
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import bag, plan_of
from salesprep import contracts, staging
from salesprep.sources import catalog, files, jdbc


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, name, staging.new_path(spark, "database"))
    return name


def test_csv_keeps_codes_and_spaces(spark):
    df = spark.createDataFrame([("0010", " a ", None), ("D|1", "x,y", "1,234")], "`Code A` string, b string, c string")
    path = staging.new_path(spark, "csv")
    files.write_csv(df, path, sep="|")
    assert bag(files.read_csv(spark, path, sep="|")) == bag(df)
    assert bag(files.read_csv(spark, path, df.schema, sep="|")) == bag(df)


def test_moved_column_raises(spark):
    path = staging.new_path(spark, "csv")
    files.write_csv(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    swapped = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.StringType())])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, swapped).collect()


def write_file(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_latest_snapshot_is_a_file_or_a_folder(spark, tmp_path):
    write_file(tmp_path / "SALES_20200101.csv", "a\nold\n")
    write_file(tmp_path / "SALES_20200201" / "part-0.csv", "a\nnew\n")
    write_file(tmp_path / "SALES_20200201" / "part-1.csv", "a\nnewer\n")
    write_file(tmp_path / "TARGET_20201201.csv", "a\nother\n")
    write_file(tmp_path / "_SALES_20990101.csv", "a\nhidden\n")
    (tmp_path / "SALES_20990101").mkdir()
    names = files.snapshot_names(spark, f"file://{tmp_path}")
    assert names == ["SALES_20200101.csv", "SALES_20200201", "SALES_20990101", "TARGET_20201201.csv"]
    # a folder without files is no snapshot
    assert bag(files.read_latest(spark, f"file://{tmp_path}/", "SALES_")) == {("new",): 1, ("newer",): 1}


def test_only_candidates_are_listed(spark, tmp_path):
    for name in ("A[1]*_2020.csv", "A1_2021.csv", "A[1]x_2022.csv", "{A?}_2023.csv"):
        write_file(tmp_path / name, "a\nx\n")
    assert files.snapshot_names(spark, str(tmp_path), "A[1]*") == ["A[1]*_2020.csv"]
    assert files.snapshot_names(spark, str(tmp_path), "{A?}") == ["{A?}_2023.csv"]
    assert files.snapshot_names(spark, str(tmp_path), "202") == sorted(["A[1]*_2020.csv", "A1_2021.csv", "A[1]x_2022.csv", "{A?}_2023.csv"])
    assert files.snapshot_names(spark, str(tmp_path / "none")) == []
    for i in range(3):
        write_file(tmp_path / "2023_b" / f"part-{i}.csv", "a\n")
    listed, glob = [], files.file_system

    def seen(session, path):
        listed.append(path)
        return glob(session, path)

    files.file_system = seen
    try:
        assert files.latest_snapshot(spark, str(tmp_path), "2023").endswith("{A?}_2023.csv")
    finally:
        files.file_system = glob
    assert listed == [f"{tmp_path}/*2023*", f"{tmp_path}/{{A?}}_2023.csv"]


def test_dated_snapshot(spark, tmp_path):
    write_file(tmp_path / "POS_20200229_1.csv", "a|b\n1|2\n")
    write_file(tmp_path / "POS_20200301_1.csv", "a|b\n3|4\n")
    write_file(tmp_path / "POS_20200301_2.csv", "a|b\n5|6\n")
    end = F.lit(datetime.date(2020, 2, 29))
    view = f"v_{uuid.uuid4().hex}"
    assert bag(files.read_dated(spark, str(tmp_path), "POS_", end, view=view)) == {("5", "6"): 1}
    assert bag(spark.table(view)) == {("5", "6"): 1}
    with pytest.raises(FileNotFoundError):
        files.read_dated(spark, str(tmp_path), "POS_", F.lit(datetime.date(2020, 2, 28)))


def test_lookup_and_pos_columns_are_found_by_name(spark, tmp_path):
    write_file(tmp_path / "areas.csv", "more,CUSTOM_ATTR14,RB_CUST_CODE\nx,Area,0010\n")
    areas = files.read_lookup(spark, str(tmp_path / "areas.csv"), contracts.AREA_FILE, contracts.AREA_NAMES)
    assert bag(areas) == {("0010", "Area"): 1}
    with pytest.raises(ValueError, match="Material"):
        files.read_lookup(spark, str(tmp_path / "areas.csv"), contracts.RESTRICTED_FILE, contracts.RESTRICTED_NAMES)
    text = "SalesRepName|SalesRepCode|POSStatus|PartnerCode|POSDesc|POSCode|more\nn|r|1|P|d|007|x\n"
    write_file(tmp_path / "pos" / "POS_20200228.csv", text)
    pos = files.read_pos(spark, str(tmp_path / "pos"), "POS_", F.lit(datetime.date(2020, 2, 28)))
    assert pos.columns == list(contracts.POS_NAMES)
    assert bag(pos) == {("007", "d", "P", "1", "r", "n"): 1}


def test_month_predicates():
    assert jdbc.month_predicates("year_month", "201911", "202002") == [
        "year_month = '2019/11'",
        "year_month = '2019/12'",
        "year_month = '2020/01'",
        "year_month = '2020/02'",
    ]


class Reader:
    """Stands for ``spark.read``: records the call."""

    def __init__(self, counts=()):
        self.calls, self.counts = [], counts
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self

    def collect(self):
        return self.counts


def test_jdbc_splits_the_read():
    properties = jdbc.jdbc_properties("some.Driver", "u", "p")
    reader = Reader()
    with pytest.raises(ValueError, match="split"):
        jdbc.read_jdbc(reader, "jdbc:x", "t", properties)
    jdbc.read_jdbc(reader, "jdbc:x", "t", properties, unsplit=True)
    jdbc.read_jdbc(reader, "jdbc:x", "t", properties, predicates=["a = 1"])
    jdbc.read_jdbc(reader, "jdbc:x", "t", properties, partition=("id", 0, 100, 4))
    assert [sorted(options) for _, _, options in reader.calls] == [
        ["properties"],
        ["predicates", "properties"],
        ["column", "lowerBound", "numPartitions", "properties", "upperBound"],
    ]
    assert properties["fetchsize"] == "10000"


def test_split_predicates_are_disjoint_and_cover(spark):
    """Spark stands for the database: each row meets exactly one predicate, and no task gets many more rows than the bound."""
    month = F.concat(F.lit("2020/0"), F.floor(F.sqrt("id") / 30 + 1).cast("string"))
    table = spark.range(10_000).select(month.alias("ym"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("n"))
    counts = [tuple(r) for r in table.groupBy("ym").count().collect()]
    predicates = jdbc.split_predicates(counts, "ym", "MOD(n, {buckets})", 500)
    assert len(predicates) == sum(-(-n // 500) for _, n in counts)
    hits = table.select(*[F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(predicates)])
    assert hits.select(sum(F.col(c) for c in hits.columns).alias("n")).distinct().collect() == [(1,)]
    # rows without a number all go with the first of their month
    sizes = table.where("n IS NOT NULL").select(*[F.count_if(F.expr(p)) for p in predicates]).first()
    assert 0 < min(sizes) and max(sizes) <= 500
    assert jdbc.split_predicates([("2020/01", 3), ("o'x", 500)], "ym", rows_per_task=500) == ["ym = '2020/01'", "ym = 'o''x'"]
    with pytest.raises(ValueError, match="2020/01"):
        jdbc.split_predicates([("2020/01", 501)], "ym", rows_per_task=500)


def test_months_are_read_by_their_histogram():
    reader = Reader([("2020/01", 10), ("2020/02", 25)])
    jdbc.read_months(reader, "jdbc:x", "sales", {"user": "u"}, "202001", "202003", "ym", "MOD(n, {buckets})", 10)
    (_, grouped, _), (_, table, options) = reader.calls
    assert grouped == "(SELECT ym AS sales_month, COUNT(*) AS row_count FROM sales WHERE ym BETWEEN '2020/01' AND '2020/03' GROUP BY ym) months"
    assert table == "sales" and options["predicates"] == [
        "ym = '2020/01'",
        "ym = '2020/02' AND (MOD(n, 3) = 0 OR MOD(n, 3) IS NULL)",
        "ym = '2020/02' AND (MOD(n, 3) = 1)",
        "ym = '2020/02' AND (MOD(n, 3) = 2)",
    ]
    empty = Reader()
    jdbc.read_months(empty, "jdbc:x", "sales", {}, "202001", "202003")
    assert empty.calls[-1][2]["predicates"] == ["1 = 0"]


def test_tables(spark, database):
    table = f"{database}.`6m_extract`"
    first = spark.createDataFrame([("a", 1)], "region string, x int")
    catalog.save_table(first.withColumn("more", F.lit(1)), table)
    catalog.save_table(first, table)
    assert bag(spark.table(table)) == bag(first)
    for _ in range(2):
        catalog.copy_table(spark, table, f"{database}.copy")
    assert bag(spark.table(f"{database}.copy")) == bag(first)


def test_saving_one_region_keeps_the_others(spark, database):
    table = f"{database}.sales"
    rows = [("N", 1), ("S", 2), ("S", 3), ("O'W \\", 4), ("E", 5)]
    catalog.save_by_region(spark.createDataFrame(rows, "region string, x int"), table)
    again = spark.createDataFrame([(9, "S"), (8, "N")], "x int, region string")
    catalog.save_by_region(again, table, regions=["S", "O'W \\", "new"])
    assert bag(spark.table(table).select("region", "x")) == {("N", 1): 1, ("S", 9): 1, ("E", 5): 1}
    plan = plan_of(catalog.read_region(spark, table, "S"))
    assert "PartitionFilters: [isnotnull(region" in plan
    catalog.save_by_region(again.where("region = 'N'"), table)
    assert bag(spark.table(table).select("region", "x")) == {("N", 8): 1}
    first = f"{database}.first"
    catalog.save_by_region(again, first, regions=["S"])
    catalog.save_by_region(again, first, regions=["N"])
    assert bag(spark.table(first).select("region", "x")) == {("N", 8): 1, ("S", 9): 1}


def test_a_failed_write_leaves_the_old_rows(spark, database):
    table = f"{database}.sales"
    old = spark.createDataFrame([("N", 1), ("S", 2)], "region string, x int")
    catalog.save_by_region(old, table)
    fails = spark.createDataFrame([("N", 7), ("S", 8)], "region string, x int").withColumn(
        "x", F.when(F.col("x") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("x")).cast("int")
    )
    home = catalog.details(spark, table)["Location"]
    for regions in (["N", "S"], None):
        with pytest.raises(Exception, match="no"):
            catalog.save_by_region(fails, table, regions=regions)
        assert bag(spark.table(table).select("region", "x")) == {("N", 1): 1, ("S", 2): 1}
        assert not [name for name in catalog.children(spark, home) if name.startswith("_") and name != "_SUCCESS"]


def test_partitions_are_switched_not_rewritten(spark, database):
    """A reader that has planned its read before the switch still names the old files; the others lie untouched."""
    table = f"{database}.sales"
    catalog.save_by_region(spark.createDataFrame([("N", 1), ("S", 2), (None, 3)], "region string, x int"), table)
    home = catalog.details(spark, table)["Location"]
    others = set(spark.table(table).where("region = 'S'").inputFiles())
    for x in (5, 6):
        catalog.save_by_region(spark.createDataFrame([("N", x)], "region string, x int"), table, regions=["N"])
        assert bag(spark.table(table).select("region", "x")) == {("N", x): 1, ("S", 2): 1, (None, 3): 1}
        assert set(spark.table(table).where("region = 'S'").inputFiles()) == others
        assert sum(name.startswith("_") and name != "_SUCCESS" for name in catalog.children(spark, home)) == 1
    # all partitions, and a change of type, which makes the table anew
    catalog.save_by_region(spark.createDataFrame([("S", 9), (None, 8)], "region string, x int"), table)
    assert bag(spark.table(table).select("region", "x")) == {("S", 9): 1, (None, 8): 1}
    catalog.save_by_region(spark.createDataFrame([("E", "y")], "region string, x string"), table)
    assert bag(spark.table(table).select("region", "x")) == {("E", "y"): 1}


def test_view(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert bag(catalog.through_view(df, "numbers_view", "select x from numbers_view where x > 1")) == {(2,): 1}


def test_work_folder_comes_from_the_session(spark):
    assert staging.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    assert staging.new_path(spark, "x") != staging.new_path(spark, "x")
