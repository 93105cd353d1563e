"""Time the two runs on about six million rows each, the size the baseline speaks of.

The landed views of the given tables are repeated under other codes. Prints one
JSON line with seconds and rows per second. ``SKEW=1`` gives one store a third
of the sales rows.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import views  # noqa: E402
from checks.queries import AS_OF, HEALTH  # noqa: E402
from salesprep.markets import profile  # noqa: E402
from salesprep.plans import publish, region  # noqa: E402
from salesprep.session import settings_for  # noqa: E402
from salesprep.sources import catalog  # noqa: E402
from salesprep.staging import new_path, stage  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "20g")
    for name, value in settings_for(2 << 30, cpus).items():
        builder = builder.config(name, value)
    spark = builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    views.ensure_work_folder(spark)
    spark.sparkContext.setLogLevel("ERROR")

    views.land(spark, sf_dir)
    copy = F.col("copy").cast("string")
    repeated = views.sales(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9))))
    hot = os.environ.get("SKEW") == "1"
    store = F.concat("store_code", F.lit("x"), copy)
    if hot:
        store = F.when(F.pmod(F.xxhash64("address", "value_sales", "copy"), F.lit(3)) == 0, "1000341000_C_3").otherwise(store)
    sales = stage(
        repeated.withColumns({"store_code": store, "city": F.concat("city", copy)}).drop("copy").repartition(4 * cpus),
        "sales",
    )
    raw = stage(
        views.extract(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(39))))
        .withColumns({"order_key": F.col("order_key") * 40 + F.col("copy"), "year_month": F.lit("1998/03")})
        .drop("copy")
        .toDF(*views.RAW_HEADERS)
        .repartition(4 * cpus),
        "raw",
    )
    pos, areas = views.pos(spark, sf_dir), views.area_map(spark, sf_dir)
    database = f"bench_{uuid.uuid4().hex}"
    catalog.ensure_database(spark, database, new_path(spark, "database"))
    tables = {name: f"{database}.{name}" for name in ("sales", "areas", "copy", "history", "focus")}
    lookups = region.Lookups(pos=pos, restricted=views.restricted_skus(spark, sf_dir))
    market = profile("INDIA_HEALTH")
    no_copy = profile("INDO_HOME")

    def timed(rows: int, run) -> dict[str, float]:
        start = time.perf_counter()
        run()
        seconds = time.perf_counter() - start
        return {"rows": rows, "seconds": round(seconds, 2), "rows_per_second": round(rows / seconds)}

    raw_rows, sales_rows = raw.count(), sales.count()
    results = {
        "country": timed(
            raw_rows,
            lambda: publish.publish_country(
                spark,
                publish.correct_partners(publish.extract_sales(raw, _all_outlets(), AS_OF), pos, areas, HEALTH),
                areas,
                no_copy,
                tables["sales"],
                tables["areas"],
            ),
        )
    }
    corrected = spark.table(tables["sales"]).count()
    results["copy"] = timed(corrected, lambda: catalog.copy_table(spark, tables["sales"], tables["copy"]))
    results["region"] = timed(
        sales_rows, lambda: publish.run_region(market, sales, lookups, tables["history"], tables["focus"])
    )
    results["region"]["history_rows"] = spark.table(tables["history"]).count()
    spark.stop()
    print(json.dumps({"skewed": hot, **results}))


def _all_outlets():
    """The file market's rules without its outlet filter, so that all rows are written."""
    return dataclasses.replace(HEALTH, outlet_rules=False)


if __name__ == "__main__":
    main()
