import pytest
from pyspark.sql import functions as F

from helpers import bag, plan_of
from salesprep import staging
from salesprep.operators.lookup import (
    LIMITS,
    Limits,
    filter_bits,
    fits,
    hot_keys,
    join_lookup,
    join_on,
    sketch,
    sketched_hot_keys,
    spread_join,
    with_possible,
)
from salesprep.staging import Size, measure, scope, stage, stage_measured, stage_observed

SHUFFLED = Limits(broadcast_rows=0, rows_per_task=10)


@pytest.fixture(scope="module")
def fact(spark):
    """Half of the rows share one key, some have none."""
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 31 != 0, F.concat(F.lit("k"), (F.col("id") % 40)))
    return spark.range(0, 1000, 1, 4).select(key.alias("k"), (F.col("id") % 7).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("hot", "a"), ("hot", "b"), ("k1", "c"), ("k3", None), ("none", "d"), (None, "e")]
    return spark.createDataFrame(rows, "k string, w string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [[], ["k"]])
def test_both_ways_agree(spark, no_auto_broadcast, fact, lookup, how, null_safe):
    small = join_lookup(fact, lookup, ["k"], how, null_safe)
    large = join_lookup(fact, lookup, ["k"], how, null_safe, limits=SHUFFLED)
    assert small.columns == large.columns
    assert bag(small) == bag(large)
    assert "BroadcastHashJoin" in plan_of(small)
    assert "SortMergeJoin" in plan_of(large)


def test_hot_rows_use_several_tasks(spark, no_auto_broadcast, fact, lookup):
    joined = spread_join(fact, lookup.dropDuplicates(["k"]), ["k"], "left", limits=SHUFFLED)
    tasks = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4


def test_equal_rows_use_several_tasks(spark, no_auto_broadcast):
    copies = spark.range(0, 800, 1, 16).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    one = spark.createDataFrame([("hot", "a")], "k string, w string")
    joined = spread_join(copies, one, ["k"], "left", limits=SHUFFLED)
    assert joined.count() == 800
    assert joined.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_every_key_above_the_bound_is_split(spark):
    counts = spark.createDataFrame([(f"k{i}", i % 40) for i in range(30_000)], "k string, _rows bigint")
    found = {row.k: row._salts for row in hot_keys(counts, ["k"], Limits(rows_per_task=10)).collect()}
    assert found == {f"k{i}": -(-(i % 40) // 10) for i in range(30_000) if i % 40 > 10}


def test_hot_keys_are_no_more_than_their_table_may_hold(spark):
    counts = spark.createDataFrame([(f"k{i}", 10 + i) for i in range(100)], "k string, _rows bigint")
    limits = Limits(rows_per_task=1, hot_rows=60)
    threshold = -(-sum(10 + i for i in range(100)) // 60)
    found = hot_keys(counts, ["k"], limits).collect()
    assert {row.k for row in found} == {f"k{i}" for i in range(100) if 10 + i > threshold}
    assert len(found) <= 60


def test_left_columns_keep_their_order(spark):
    left = spark.createDataFrame([(1, "a", 2)], "x int, k string, y int")
    right = spark.createDataFrame([("a", 3)], "k string, z int")
    assert join_on(left, right, ["k"], "left").columns == ["x", "k", "y", "z"]


def test_size_is_measured(spark, lookup):
    size = measure(lookup)
    assert size == Size(6, len("hothotk1k3none" + "abcde"))
    staged, seen = stage_measured(lookup, "test")
    assert seen == size
    assert bag(staged) == bag(lookup)
    assert fits(size) and not fits(size, Limits(broadcast_rows=5)) and not fits(size, Limits(broadcast_bytes=5))
    assert measure(lookup.where("false")) == Size(0, 0)


def test_stage_cuts_the_lineage(spark):
    df = spark.createDataFrame([(1, True, "x"), (2, False, None)], "a int, p boolean, s string")
    staged = stage(df, "test", ["p"])
    assert staged.columns == df.columns
    assert bag(staged) == bag(df)
    assert "FileScan parquet" in plan_of(staged)


# -- sketch and filter --------------------------------------------------------------


def sketched(spark, fact, limits):
    _, values = stage_observed(fact, "test", *sketch(["k"], limits))
    hot = sketched_hot_keys(spark, values, limits)
    return {} if hot is None else {row._key: row._salts for row in hot.collect()}


def test_sketch_finds_every_key_above_the_bound(spark):
    keys = [f"k{i}" for i in range(3000) for _ in range(2)] + ["warm"] * 400 + ["hot"] * 900 + [None] * 700
    fact = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    limits = Limits(rows_per_task=100, sketch_items=256)
    found = sketched(spark, fact, limits)
    hashes = {r.k: r.h for r in fact.distinct().select("k", F.xxhash64("k").alias("h")).collect()}
    assert {hashes["hot"], hashes["warm"], hashes[None]} <= found.keys() and len(found) < 64
    assert found[hashes["hot"]] >= 2
    assert sketched(spark, fact, LIMITS) == {}
    assert sketched(spark, fact.where("false"), limits) == {}


class Counting:
    """Counts how often rows of a table are computed."""

    def __init__(self, spark, df):
        self.rows = spark.sparkContext.accumulator(0)
        total = self.rows

        def count(batches):
            for batch in batches:
                total.add(batch.num_rows)
                yield batch

        self.df = df.mapInArrow(count, df.schema)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_fact_and_lookup_are_computed_once(spark, no_auto_broadcast, fact, lookup, how):
    counted, listed = Counting(spark, fact), Counting(spark, lookup)
    joined = join_lookup(counted.df, listed.df, ["k"], how, limits=SHUFFLED)
    assert bag(joined) == bag(join_lookup(fact, lookup, ["k"], how))
    assert (counted.rows.value, listed.rows.value) == (fact.count(), lookup.count())


def test_filter_loses_no_row(spark):
    fact = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("v"))
    lookup = fact.where("v = 0").select("k").limit(5000)
    bits = filter_bits(Size(5000, 0))
    assert bits == 1 << 17
    flagged = with_possible(fact, lookup, ["k"], bits)
    assert flagged.columns == [*fact.columns, "_possible"]
    listed = {r.k for r in lookup.collect()}
    possible = {r.k for r in flagged.where("_possible").collect()}
    assert listed <= possible and len(possible - listed) < 0.1 * 15_000
    plan = plan_of(flagged.where("_possible"))
    # the filter works where the rows lie: nothing of the fact is exchanged
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(k" not in plan and "SortMergeJoin" not in plan


def test_filter_stands_below_the_shuffled_join(spark, no_auto_broadcast, monkeypatch):
    """What is staged for the join, and hence exchanged, are the rows the filter leaves."""
    fact = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"))
    lookup = fact.limit(100)
    plans, write = [], staging.stage

    def seen(df, name, partition_by=()):
        plans.append((name, plan_of(df), write(df, name, partition_by)))
        return plans[-1][-1]

    monkeypatch.setattr(staging, "stage", seen)
    joined = join_lookup(fact, lookup, ["k"], "left_semi", limits=Limits(broadcast_rows=0))
    written = [(plan, staged) for name, plan, staged in plans if name == "fact"]
    assert len(written) == 1 and "getbit" in written[0][0] and "SortMergeJoin" not in written[0][0]
    assert 100 <= written[0][1].count() < 2_000
    assert "SortMergeJoin" in plan_of(joined) and joined.count() == 100


def test_filter_is_bounded():
    assert filter_bits(Size(1, 0)) == 32_768
    assert filter_bits(Size(10**6, 0)) == 1 << 24
    most = Limits(broadcast_bytes=1 << 20)
    assert filter_bits(Size(10**6, 0), most) == 1 << 23
    assert filter_bits(Size(10**7, 0), most) is None


def test_other_types_join_plainly(spark, no_auto_broadcast):
    fact = spark.createDataFrame([(1.0, "a"), (-0.0, "b"), (0.0, "c")], "k double, v string")
    lookup = spark.createDataFrame([(0.0,), (1.0,)], "k double")
    assert bag(join_lookup(fact, lookup, ["k"], "left_semi", limits=SHUFFLED)) == bag(fact)
    texts = spark.createDataFrame([("1",), ("2",)], "k string")
    numbers = spark.createDataFrame([(1,), (3,)], "k int")
    assert join_lookup(numbers, texts, ["k"], "left_anti", limits=SHUFFLED).count() == 1


# -- scopes -------------------------------------------------------------------------


def folders(spark):
    files, place = staging.file_system(spark, staging.work_folder(spark))
    return {s.getPath().getName() for s in files.listStatus(place)} if files.exists(place) else set()


def test_scope_deletes_what_is_not_kept(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    before = folders(spark)
    with scope(spark) as outer:
        with scope(spark) as inner:
            kept, gone = stage(df, "kept"), stage(df, "gone", ["y"])
            result = kept.join(gone.limit(0), "x", "left_anti").where("x > 0")
            inner.keep(kept.where("x > 1"), None)
        assert len(folders(spark) - before) == 1
        assert bag(kept) == bag(df)
        outer.keep()
    assert folders(spark) == before
    with pytest.raises(Exception, match="(?i)not.*exist"):
        result.collect()
    with scope(spark) as alone:
        last = stage(df, "last")
        alone.keep(last)
    assert bag(last) == bag(df) and len(folders(spark) - before) == 1


def test_tables_can_be_dropped_before_the_end(spark):
    before = folders(spark)
    with scope(spark) as own:
        first = stage(spark.range(3), "first")
        second = stage(first, "second")
        own.drop(spark, first)
        assert len(folders(spark) - before) == 1 and second.count() == 3
    assert folders(spark) == before


def test_failed_work_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ValueError, match="fails"), scope(spark) as own:
        own.keep(stage(spark.range(3), "kept"))
        raise ValueError("fails")
    assert folders(spark) == before
