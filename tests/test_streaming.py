"""Streaming maintenance of the visit table equals the batch collapse."""

import os

from pyspark.sql import functions as F

from touchline.operators.visits import latest_live_visits
from touchline.streaming import start_visit_maintenance

START, END = "2024-01-02", "2024-01-29"


def _key(df):
    return sorted((r.VisitID, r.Duration, r.Conversions, r.Revenue) for r in df.collect())


def test_two_arrivals_then_late_versions(spark, raw001, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw")
    out = os.path.join(tmpdir_path, "visits")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    early = raw001.where(F.col("VisitVersion") == 1)
    late = raw001.where(F.col("VisitVersion") > 1)
    early.write.mode("append").parquet(raw_dir)
    start_visit_maintenance(spark, raw_dir, out, START, END, checkpoint_location=ckpt).awaitTermination()
    assert _key(spark.read.parquet(out)) == _key(latest_live_visits(early, START, END))
    # later versions and cancel rows arrive: their days are rebuilt from all rows
    late.write.mode("append").parquet(raw_dir)
    start_visit_maintenance(spark, raw_dir, out, START, END, checkpoint_location=ckpt).awaitTermination()
    got = spark.read.parquet(out)
    exp = latest_live_visits(raw001, START, END)
    assert got.count() == exp.count() == 887
    assert _key(got) == _key(exp)


def test_day_fully_cancelled_later_is_removed(spark, raw001, tmpdir_path):
    raw_dir = os.path.join(tmpdir_path, "raw2")
    out = os.path.join(tmpdir_path, "visits2")
    ckpt = os.path.join(tmpdir_path, "ckpt2")
    day = F.col("StartDate") == F.lit("2024-01-05").cast("date")
    raw001.where(day & (F.col("Sign") == 1)).write.mode("append").parquet(raw_dir)
    start_visit_maintenance(spark, raw_dir, out, START, END, checkpoint_location=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() > 0
    # cancel rows for every row of that day arrive: the day has no live visit left
    cancels = raw001.where(day & (F.col("Sign") == 1)).withColumn("Sign", F.lit(-1))
    cancels.write.mode("append").parquet(raw_dir)
    start_visit_maintenance(spark, raw_dir, out, START, END, checkpoint_location=ckpt).awaitTermination()
    assert not os.path.exists(os.path.join(out, "StartDate=2024-01-05"))
