"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the cores of the local session.
Every query starts from the base tables and is written to a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from testbed.queries import QUERIES

HEADLINE = [
    "prepare_input",
    "count_by_subset",
    "count_rollup_all",
    "median_rollup",
    "fused_cells",
    "ratio_by_subset",
    "compare_expected",
    "full_report",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.maxFields", "350")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    seconds(spark, "input_count", sf_dir)  # starts the session and reads footers
    times = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
