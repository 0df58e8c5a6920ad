"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  folder of the Parquet tables  (default /root/testdata/sf0.1)
    BENCH_CPUS    cores for local mode          (default 8)
    BENCH_RUNS    timed runs; the best counts   (default 3)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tallyworks.plans.catalog import QUERIES

HEADLINE = (
    "orders_full",
    "join_left",
    "join_full_classified",
    "amount_stats",
    "monthly_revenue",
    "rfm",
    "customer_ltv",
    "top_customers",
    "category_revenue",
    "category_revenue_shuffle",
    "revenue_by_product",
    "avg_order_value",
    "grouped_orders",
    "business_summary",
    "word_explode",
    "log_quality",
    "log_timestamps",
    "status_distribution",
    "conversion_funnel",
    "bounce_rate",
    "suspicious_rate",
    "slow_endpoints",
    "md5_partition",
    "salted_sum",
    "skew_sum",
    "shared_enrichment",
    "csv_roundtrip",
    "parquet_roundtrip",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyworks-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column, and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def best_of(runs: int, spark: SparkSession, name: str, data_dir: str) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        drain(QUERIES[name].run(spark, data_dir))
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    drain(QUERIES["amount_stats"].run(spark, data_dir))  # start-up is not timed
    times = {name: best_of(runs, spark, name, data_dir) for name in names}
    spark.stop()
    scale = re.search(r"sf([\d.]+)", data_dir)
    result = {
        "metric": "total seconds of the headline queries, best run of each",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
