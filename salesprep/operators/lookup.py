"""Joins of a large fact with a lookup of unknown size.

A lookup is staged and measured in one pass. Within the bounds it is broadcast. Beyond
them the fact is staged once, and a sketch of its keys is gathered while it is
written; then both sides are shuffled, and the keys that hold most rows of the
fact are spread over several tasks, with their lookup rows repeated once per task.

Semi and anti joins look at a Bloom filter of the lookup's keys first: rows that it
rules out are settled where they lie and are neither staged for the join nor shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesprep.staging import Size, stage_measured, stage_observed


@dataclass(frozen=True)
class Limits:
    """Bounds of a broadcast side, and the rows of a key that one task may get.

    Every key above ``rows_per_task`` is spread, or above the fact's rows divided by
    ``hot_rows`` if that is more: then no more than ``hot_rows`` keys can be
    above it, whatever the data, and their table may be broadcast. A sketch follows
    ``sketch_items`` keys in each task (about 25 bytes each, which the driver adds up) and finds every key with
    more than four of so many parts of the rows; AQE splits what is between.
    """

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024
    rows_per_task: int = 2_000_000
    hot_rows: int = 1_000_000
    sketch_items: int = 4096


LIMITS = Limits()

#: Bits of a filter for each key, and the fewest with which it is worth its broadcast.
FILTER_BITS, LEAST_FILTER_BITS = 16, 4
#: Bits in a row of a filter: those of one bitmap of ``bitmap_construct_agg``.
BITMAP = 32_768

#: Types whose equal values have equal hashes.
HASHED = (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType)


def fits(size: Size, limits: Limits = LIMITS) -> bool:
    """Whether a side of this size may be broadcast."""
    return size.rows <= limits.broadcast_rows and size.bytes <= limits.broadcast_bytes


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: Sequence[str] = ()
) -> DataFrame:
    """Join on equally named keys; keys in ``null_safe`` match null to null.

    The columns of ``left`` come first, in their order.
    """
    other = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})

    def same(key: str) -> Column:
        mine, theirs = F.col(key), F.col(f"_right_{key}")
        return mine.eqNullSafe(theirs) if key in null_safe else mine == theirs

    return left.join(other, reduce(and_, map(same, keys)), how).drop(*[f"_right_{key}" for key in keys])


def hashable(fact: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> bool:
    """Whether keys that match have one hash on both sides."""
    return all(
        fact.schema[key].dataType == lookup.schema[key].dataType and isinstance(fact.schema[key].dataType, HASHED)
        for key in keys
    )


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{key}`") for key in keys])


# -- hot keys ---------------------------------------------------------------------


def hot_keys(counts: DataFrame, keys: Sequence[str], limits: Limits = LIMITS) -> DataFrame:
    """Every key with more rows than a task may get, and the number of tasks it deserves (``_salts``).

    ``counts`` holds the keys and ``_rows``. No more than ``limits.hot_rows``
    rows come out, hence safe to broadcast.
    """
    fact_rows = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    threshold = max(limits.rows_per_task, -(-fact_rows // limits.hot_rows))
    hot = counts.where(F.col("_rows") > threshold)
    return hot.select(*keys, F.ceil(F.col("_rows") / threshold).cast("int").alias("_salts"))


def sketch(keys: Sequence[str], limits: Limits = LIMITS, only: str = "true") -> list[Column]:
    """Aggregates over the rows with ``only``: their number, and the hashes of the keys that hold most of them."""
    names = ", ".join(f"`{key}`" for key in keys)
    items = max(4, limits.sketch_items)
    top = F.expr(f"approx_top_k(CASE WHEN {only} THEN xxhash64({names}) END, {items // 4}, {items})")
    return [F.count_if(F.expr(only)).alias("rows"), top.alias("top")]


def sketched_hot_keys(spark: SparkSession, values: dict, limits: Limits = LIMITS) -> DataFrame | None:
    """Hash (``_key``) and ``_salts`` of the hot keys that a ``sketch`` has seen; none if it has seen none.

    Too few or too many salts cost time only: both sides take them from this table.
    """
    threshold = max(limits.rows_per_task, -(-4 * values.get("rows", 0) // max(4, limits.sketch_items)))
    seen = [(x["item"], x["count"]) for x in values.get("top") or () if x["item"] is not None]
    hot = [(key, -(-count // threshold)) for key, count in seen if count > threshold]
    return spark.createDataFrame(hot, "_key long, _salts int") if hot else None


def salted_join(
    fact: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, null_safe: Sequence[str], hot: DataFrame, by: Sequence[str]
) -> DataFrame:
    """Shuffled join in which the keys of ``hot`` (columns ``by`` and ``_salts``) use many tasks.

    The salt mixes in the input partition, so equal rows do not meet again in one
    task; it is the same when a task is run again.
    """
    hot = F.broadcast(hot)
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns], F.spark_partition_id())
    keyed = [df.withColumn("_key", key_hash(keys)) if list(by) == ["_key"] else df for df in (fact, lookup)]
    left = (
        join_on(keyed[0], hot, by, "left", null_safe=by)
        .withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(mixed, F.col("_salts")).cast("int")))
        .drop("_salts", "_key")
    )
    right = (
        join_on(keyed[1], hot, by, "left", null_safe=by)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts", "_key")
    )
    return join_on(left, right, [*keys, "_salt"], how, null_safe).drop("_salt")


def spread_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: Sequence[str] = (),
    counts: DataFrame | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Shuffled join in which hot keys of the fact use many tasks. Without hot keys it is a plain join.

    ``counts`` (keys and ``_rows``) saves staging the fact for a sketch of its keys.
    """
    if counts is not None:
        hot, size = stage_measured(hot_keys(counts, keys, limits), "hot-keys")
        return salted_join(fact, lookup, keys, how, null_safe, hot, keys) if size.rows else join_on(fact, lookup, keys, how, null_safe)
    if not hashable(fact, lookup, keys):
        return join_on(fact, lookup, keys, how, null_safe)
    staged, values = stage_observed(fact, "fact", *sketch(keys, limits))
    hot = sketched_hot_keys(fact.sparkSession, values, limits)
    return join_on(staged, lookup, keys, how, null_safe) if hot is None else salted_join(staged, lookup, keys, how, null_safe, hot, ["_key"])


# -- filters ----------------------------------------------------------------------


def filter_bits(size: Size, limits: Limits = LIMITS) -> int | None:
    """Bits of a filter for a lookup, a power of two that may be broadcast; none if they would be too few."""
    most = 1 << (max(1, limits.broadcast_bytes * 8).bit_length() - 1)
    bits = min(max(BITMAP, 1 << (FILTER_BITS * size.rows).bit_length()), most)
    return bits if bits >= max(BITMAP, LEAST_FILTER_BITS * size.rows) else None


def with_possible(fact: DataFrame, lookup: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``fact`` with ``_possible``, false only where the lookup has no such key.

    The filter is a bitmap of hashes in rows of 4 KiB, at most ``bits`` bits, which are broadcast.
    """

    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("_place", F.pmod(key_hash(keys), F.lit(bits)))

    bitmaps = (
        place(lookup)
        .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    )
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    keyed = place(fact).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    found = join_on(keyed, F.broadcast(bitmaps), ["_bucket"], "left")
    possible = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return found.select(*fact.columns, possible.alias("_possible"))


def filtered_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    bits: int,
    null_safe: Sequence[str] = (),
    limits: Limits = LIMITS,
) -> DataFrame:
    """Shuffled semi or anti join of the rows that a filter of the lookup's keys leaves open."""
    flagged = with_possible(fact, lookup, keys, bits)
    if how == "left_semi":
        return spread_join(flagged.where("_possible").drop("_possible"), lookup, keys, how, null_safe, limits=limits)
    staged, values = stage_observed(flagged, "fact", *sketch(keys, limits, "_possible"), partition_by=["_possible"])
    hot = sketched_hot_keys(fact.sparkSession, values, limits)
    open_rows, settled = (staged.where(F.col("_possible") == value).drop("_possible") for value in (True, False))
    if hot is None:
        joined = join_on(open_rows, lookup, keys, how, null_safe)
    else:
        joined = salted_join(open_rows, lookup, keys, how, null_safe, hot, ["_key"])
    return joined.unionByName(settled)


# -- the join ---------------------------------------------------------------------


def join_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: Sequence[str] = (),
    size: Size | None = None,
    counts: DataFrame | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Join a lookup by broadcast when it was measured to be small, else with hot keys spread.

    ``size`` saves staging and measuring a lookup whose size, or an upper bound of it, is known.
    """
    if size is None:
        lookup, size = stage_measured(lookup, "lookup")
    if fits(size, limits):
        return join_on(fact, F.broadcast(lookup), keys, how, null_safe)
    bits = filter_bits(size, limits) if how in ("left_semi", "left_anti") and hashable(fact, lookup, keys) else None
    if bits and counts is None:
        return filtered_join(fact, lookup, keys, how, bits, null_safe, limits)
    return spread_join(fact, lookup, keys, how, null_safe, counts, limits)
