"""Connected components of an edge table, by alternating large and small stars.

Each node points to the smallest node it knows of. A round is two aggregations;
rounds end when nothing changes, after a number that grows with the logarithm of
the longest path. Every round is written into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep.llm.shared import stage
from salesprep.staging import scope


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all nodes with an edge but the roots; edges are longs (a, b)."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with scope(edges.sparkSession) as run:
        seen = None
        while True:
            edges = stage(small_star(large_star(edges)), "components")
            total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if total == seen:
                break
            seen = total
        run.keep(edges)
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
