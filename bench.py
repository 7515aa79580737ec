"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Each query is forced to completion with a no-op write (every column, every
row computed, nothing collected), so timings include the full plan. Queries are
cold: the cache is cleared before each, and each rebuilds visits and touches from
``events``. ``shared_table_sec`` times the same reports from one stored touch table.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "latest_live_visits",
    "gap_quantile",
    "touches_segments",
    "visits_ahead_after_duration",
    "simple_attributions",
    "associated_conversions",
    "source_in_chains_metrics",
    "chains_array",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from touchline.plans.registry import QUERIES
    from touchline.session import get_session

    # local mode: let AQE keep small shuffle partitions apart so all cores stay busy
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus), app_name="touchline-bench",
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    # warm-up: JVM, parquet reader and codegen paths on the smallest table
    QUERIES["source_code_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in HEADLINE:
        spark.catalog.clearCache()      # each query starts from the events table
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    # the three reports from one materialised touch table, as a user runs them
    from touchline.plans.registry import analytics
    t0 = time.perf_counter()
    spark.catalog.clearCache()
    ca = analytics(spark, sf_dir)
    ca.combine_visits(materialize=True)
    t1 = time.perf_counter()
    for rep in (ca.simple_attributions(), ca.associated_conversions(), ca.source_in_chains_metrics()):
        rep.collect()
    shared = round(time.perf_counter() - t1, 3)
    timings["full_report_set"] = round(time.perf_counter() - t0, 3)

    # cost of skew safety: every user forced through the blocked (user, block) path
    from touchline.operators import positions
    from touchline.operators.touches import touches
    t0 = time.perf_counter()
    positions.source_measures(touches(ca.visits, ca.visit_gap_threshold(), hot_user_rows=0,
                                      block_rows=1000)).collect()
    skew_path = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    positions.source_measures(touches(ca.visits, ca.visit_gap_threshold(), hot_user_rows=None)).collect()
    plain_path = round(time.perf_counter() - t0, 3)

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "events": events,
        "cpus": int(cpus),
        "shared_table_sec": shared,
        "measures_all_users_blocked_sec": skew_path,
        "measures_plain_sec": plain_path,
    }))
    ca.release()
    spark.stop()


if __name__ == "__main__":
    main()
