"""Row counts of the steps."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesprep.staging import observed


def stage_counts(stages: Mapping[str, DataFrame], by: str = "region") -> DataFrame:
    """Rows per step and region, for steps that are not written anyway."""
    counts = [
        df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), by, "row_count")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def step_counts(df: DataFrame, steps: Mapping[str, Column], by: str = "region") -> DataFrame:
    """Rows per step and region of filters that follow each other, in one pass over ``df``.

    A step counts the rows that meet its condition and those of the steps before it.
    """
    passed, counts = F.lit(True), []
    for name, condition in steps.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    wide = df.groupBy(by).agg(*counts)
    return wide.unpivot([by], list(steps), "stage", "row_count").where("row_count > 0").select("stage", by, "row_count")


#: Regions that are counted on the way, and the name under which all rows are counted where there are more or none.
REGIONS = 4096
ALL = "*"


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen


def region_columns(by: str | None = "region") -> list[Column]:
    """Aggregates for an observation, which cannot group: rows, and rows per region from a sketch that is exact for so few."""
    rows = F.count(F.lit(1)).alias("row_count")
    if by is None:
        return [rows]
    return [rows, F.expr(f"approx_top_k(coalesce(cast(`{by}` AS string), ''), {REGIONS}, {4 * REGIONS})").alias("by_region")]


def region_counts(values: Mapping) -> dict[str, int]:
    """Rows per region (no region: an empty name) of observed ``region_columns``; all rows under ``ALL`` if they are not exact."""
    rows, counts = values.get("row_count", 0), {x["item"]: x["count"] for x in values.get("by_region") or ()}
    if sum(counts.values()) == rows:
        return dict(sorted(counts.items()))
    return {ALL: rows}


class Steps:
    """Rows per step and region, counted while other actions run the steps.

    A step stops filters from moving through it, so it belongs behind those that should reach a scan.
    """

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}
        self.known: dict[str, dict[str, int]] = {}

    def watch(self, df: DataFrame, name: str, by: str | None = "region") -> DataFrame:
        self.seen[name] = Observation()
        self.known[name] = {}
        return df.observe(self.seen[name], *region_columns(by))

    def add(self, name: str, values: Mapping) -> None:
        """A step whose ``region_columns`` were observed elsewhere."""
        self.known[name] = region_counts(values)

    def counts(self) -> dict[str, dict[str, int]]:
        """Step to region to rows; each watched step must have been run by some action."""
        return {name: region_counts(observed(self.seen[name])) if name in self.seen else known for name, known in self.known.items()}
