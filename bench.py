"""Time the headline queries; one JSON line on standard output."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from silverlode.catalog import build, stored_warehouse
from silverlode.operators.storage import scratch_path
from silverlode.session import configure
from silverlode.sources import derived

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINES = (
    "int_customer_clean",
    "int_billing_clean",
    "int_usage_clean",
    "int_network_clean",
    "int_support_clean",
    "int_churn_clean",
    "int_r3_friction_monthly",
    "dim_plan",
    "fact_billing",
    "fact_usage_snapshot",
    "fact_customer_month_snapshot",
    "mart_r1_churn_early",
    "mart_r4_campaigns",
    "mart_r5_crispdm_dataset",
    "order_item",
    "upsert",
    "upsert_files",
)


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of each column expression are for debugging only.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return configure(builder).getOrCreate()


def prepare(spark: SparkSession) -> str:
    """Write the raw tables once, as they would be found on a cluster."""
    root = scratch_path(spark, tempfile.gettempdir() + "/bench")
    for source in derived.STATEMENTS:
        derived.derive(spark, source, SF_DIR).repartition(int(CPUS)).write.parquet(f"{root}/{source}")
    return root


def run(spark: SparkSession, name: str, root: str) -> float:
    """Seconds from the first line of the plan to the last row, raw tables to result."""
    start = time.perf_counter()
    build(name, stored_warehouse(spark, SF_DIR, root)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    root = prepare(spark)
    prepared = time.perf_counter() - start
    times = {}
    for name in HEADLINES:
        run(spark, name, root)
        times[name] = round(statistics.median(run(spark, name, root) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "prepare_sec": round(prepared, 3),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
