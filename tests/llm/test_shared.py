"""Shelved rows meet small tables without being shuffled."""

import pytest
from pyspark.sql import functions as F

from salesprep.llm import shared


@pytest.mark.parametrize("bits", [2, 12])
def test_met_rows_stay_where_they_lie(spark, monkeypatch, bits):
    monkeypatch.setattr(shared, "CHUNK_BITS", bits)
    rows = spark.range(0, 100, 1, 3).select("id", F.col("id").alias("row"))
    shelf = shared.shelve(rows, "test-shelf")
    assert shelf.columns == ["c0", "c1", "row", "chunk"]
    small = shared.stage(shelf.where("c0 % 3 = 0").select("row", F.col("c0").alias("x")), "small")
    for how, n in (("inner", 34), ("left", 100), ("left_semi", 34)):
        found = shared.met(shelf, small, how)
        assert found.count() == n
        if how != "left_semi":
            assert found.where("x <> c0").count() == 0
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "ShuffledHashJoin" in plan


def test_shelf_leaves_no_table_behind_and_may_be_empty(spark):
    before = len(spark.catalog.listTables())
    shelf = shared.shelve(spark.range(0), "test-shelf")
    assert shelf.count() == 0 and shared.met(shelf, shelf.select("row"), "left_semi").count() == 0
    assert len(spark.catalog.listTables()) == before
