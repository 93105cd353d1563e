"""Time the headline queries; prints one JSON line.

The inputs are derived from the given tables and written first (``landing``), so
that the queries are timed on tables in the shape a market delivers. Each query
runs once to warm up and is then timed once, from building the plan (with the
jobs that stage and measure) to having produced every row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import views  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "scan_csv_pipe",
    "latest_file_rows",
    "sink_overwrite_table",
    "sink_ctas_copy",
    "sink_partition_by_region",
    "filter_positive_sales",
    "filter_month_window",
    "parse_number",
    "split_store_code",
    "dedupe_sales",
    "distinct_rows",
    "latest_class_per_store",
    "remap_distributor",
    "remap_store_code",
    "semi_active_stores",
    "semi_route_stores",
    "anti_counter_outlets",
    "anti_restricted_skus",
    "focus_months_extract",
    "precedence_union_map",
    "stage_row_counts",
    "country_extract",
    "corrected_sales",
    "built_area_map",
    "sales_history",
    "focus_extract",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("salesprep-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    start = time.perf_counter()
    views.land(spark, sf_dir)
    landing = time.perf_counter() - start
    rows = views.sales(spark, sf_dir).count()

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "landing": round(landing, 3),
                "sales_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
