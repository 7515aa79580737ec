"""Skew check: one user holds a third of all visits.

Runs the per-source report measures with the plain per-user windows and with
the hot-user (user, block) path, checks the results agree, and reads the
largest task (shuffle records read) of each run from Spark's event log,
written to a fresh scratch directory. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 python bench_skew.py
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def _largest_tasks(log_dir: str) -> dict:
    import zstandard
    stage_group, records = {}, {}
    for fn in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*[!d]")):
        if os.path.isdir(fn):
            continue
        with open(fn, "rb") as fh:
            stream = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                      if fn.endswith(".zstd") else io.TextIOWrapper(fh, encoding="utf-8"))
            for line in stream:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e["Stage IDs"]:
                        stage_group[sid] = group
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    records.setdefault(e["Stage ID"], []).append(
                        (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0))
    out = {}
    for sid, recs in records.items():
        g = stage_group.get(sid)
        if g:
            out[g] = max(out.get(g, 0), max(recs))
    return out


def main() -> None:
    from pyspark.sql import functions as F

    from touchline.operators import positions
    from touchline.operators.touches import touches
    from touchline.plans import registry
    from touchline.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    log_dir = tempfile.mkdtemp(prefix="touchline-eventlog-")
    spark = get_session("local[8]", shuffle_partitions=64, app_name="touchline-skew",
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ca = registry.analytics(spark, sf_dir)
    hot = F.col("VisitID") % 3 == 0
    visits = (ca.visits.withColumn("UserID", F.when(hot, F.lit(0)).otherwise(F.col("UserID")))
              .withColumn("CounterID", F.when(hot, F.lit(1)).otherwise(F.col("CounterID"))).cache())
    n, n_hot = visits.count(), visits.where("UserID = 0").count()
    d = ca.visit_gap_threshold()
    results, seconds = {}, {}
    for label, threshold in (("plain", None), ("blocked", max(1, n_hot // 3))):
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.perf_counter()
        rows = positions.source_measures(touches(visits, d, hot_user_rows=threshold,
                                                 block_rows=max(1, n_hot // 15))).collect()
        seconds[label] = round(time.perf_counter() - t0, 3)
        results[label] = {r["SourceCode"]: r.asDict() for r in rows}
    a, b = results["plain"], results["blocked"]
    same = a.keys() == b.keys() and all(
        abs(a[k][c] - b[k][c]) <= 1e-6 * max(1.0, abs(a[k][c])) for k in a for c in a[k] if c != "SourceCode")
    spark.stop()
    largest = _largest_tasks(log_dir)
    print(json.dumps({"metric": "largest_task_records", "visits": n, "hot_user_visits": n_hot,
                      "plain": largest.get("plain"), "blocked": largest.get("blocked"),
                      "seconds": seconds, "same_results": same, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
