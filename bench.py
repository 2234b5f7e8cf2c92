"""Headline timings at one data scale, printed as one line of JSON.

Each query starts from the given tables and writes its whole result to Spark's no-op sink; it runs once untimed, then
timed. The two stage figures are the stored pipeline: Bronze to Silver (cleaning, checks, history, writes) and Silver to
Gold (the three marts), on Bronze tables prepared beforehand.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from ledgerline.plans import pipeline
from ledgerline.session import local_session
from workload.catalog import AS_OF, Layers, queries, scratch_lake

HEADLINES = (
    "scan_transactions", "dedup_transactions", "txn_ref_check", "txn_ref_check_by_exception", "dq_all_reasons",
    "upsert_transactions", "silver_customers", "silver_cards", "silver_transactions",
    "gold_spend_summary", "gold_risk_summary", "gold_segmentation", "kpi_spend", "kpi_top10_customers",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run_query(spark, sf_dir: str, name: str) -> None:
    queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def stages(spark, sf_dir: str) -> dict[str, float]:
    lake = scratch_lake(spark, "bench")
    layers = Layers(spark, sf_dir)
    pipeline.ingest_batch(lake, "merchants", layers.merchants_raw())
    for name, raw in (
        ("customers", layers.customers_raw()), ("cards", layers.cards_raw()),
        ("transactions", layers.transactions_raw()),
    ):
        pipeline.ingest_batch(lake, name, raw)
    return {
        "stage_bronze_to_silver": timed(lambda: pipeline.bronze_to_silver(lake)),
        "stage_silver_to_gold": timed(lambda: pipeline.silver_to_gold(lake, F.lit(AS_OF).cast("date"))),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        run_query(spark, sf_dir, name)
        times[name] = timed(lambda: run_query(spark, sf_dir, name))
    times |= stages(spark, sf_dir)
    print(json.dumps({
        "metric": "total seconds over headline queries and stages",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
