"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from ledgerloom.plans import benchmark, catalog
from ledgerloom.plans.model import NODES, Model
from ledgerloom.sources.commerce import raw_entities
from ledgerloom.sources.store import table_writer

# Read from the source files, every row computed.
FROM_SOURCE = ("items_by_order", "orders_enriched", "monthly_revenue")
# Built from the tables the pipeline has stored.
FROM_TABLES = (
    "dim_customer", "fct_orders", "fct_order_items", "customer_revenue", "category_revenue", "seller_revenue",
)
REPORTS = (
    "bench_delivered_kpis", "bench_monthly_mart", "rep_top_states", "pub_product_categories",
    "scd2_suite", "lineage_suite", "mart_parity", "dq_suite", "historical_scorecard",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ledgerloom-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    queries = catalog.all_queries()
    times: dict[str, float] = {}

    def record(name: str, timing: dict[str, float]) -> None:
        times[name] = round(timing["median_ms"] / 1000, 4)

    for name in FROM_SOURCE:
        record(name, benchmark.measure_write(lambda name=name: queries[name](spark, sf_dir)))
    # The whole pipeline, from source files to stored marts, in fresh folders.
    start = time.perf_counter()
    fresh = Model(raw_entities(spark, sf_dir), table_writer(spark))
    fresh.build_all()
    times["pipeline_build"] = round(time.perf_counter() - start, 4)
    for name in FROM_TABLES:
        build, inputs = NODES[name]
        record(name, benchmark.measure_write(lambda build=build, inputs=inputs: build(*(fresh[i] for i in inputs))))
    for name in REPORTS:
        record(name, benchmark.measure(lambda name=name: queries[name](spark, sf_dir), 5 if name.startswith("bench") else 3))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
