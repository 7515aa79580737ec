"""Keep the live-visit table current as raw visit files arrive.

The batch pipeline rebuilds the visit table day by day. Here a streaming
query watches the raw-visit directory; for every micro-batch it takes the
StartDates that received rows, re-reads those days in full from the raw
table (all versions and cancel rows of a visit share its StartDate), and
replaces exactly those date partitions of the visit table. A late version
or a cancel row therefore re-collapses its whole day, and re-running a
batch after a failure writes the same partitions again (idempotent).

Progress is kept in the stream checkpoint, by default under the session's
``spark.checkpoint.dir`` (shared storage on a cluster). The lists of days of
one batch (received, and still holding live visits) are the only things
collected to the driver (one row per day). A dynamic overwrite only replaces
partitions it writes, so a day whose every visit got cancelled has its
partition removed explicitly.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.visits import latest_live_visits
from touchline.schema import RAW_VISITS
from touchline.session import ensure_checkpoint_dir
from touchline.sources.sinks import write_visits_dates


def _rebuild_days(spark: SparkSession, raw_dir: str, visits_dir: str, start_date, end_date,
                  goals: Sequence[int]):
    def rebuild(batch: DataFrame, epoch_id: int) -> None:
        days = [r[0] for r in (batch.select("StartDate").distinct()
                               .where(F.col("StartDate").between(F.lit(start_date).cast("date"),
                                                                 F.lit(end_date).cast("date")))
                               .collect())]
        if not days:
            return
        raw = spark.read.schema(RAW_VISITS).parquet(raw_dir).where(F.col("StartDate").isin(days))
        visits = latest_live_visits(raw, start_date, end_date, goals).persist()
        try:
            live_days = {r[0] for r in visits.select("StartDate").distinct().collect()}
            if live_days:
                write_visits_dates(visits, visits_dir)
        finally:
            visits.unpersist()
        for day in set(days) - live_days:
            _drop_partition(spark, visits_dir, day)
    return rebuild


def _drop_partition(spark: SparkSession, table_dir: str, day) -> None:
    """Remove the StartDate partition directory of a day that no longer has live visits."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table_dir.rstrip('/')}/StartDate={day.isoformat()}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def start_visit_maintenance(spark: SparkSession, raw_dir: str, visits_dir: str, start_date: str,
                            end_date: str, goals: Sequence[int] = (-1,),
                            checkpoint_location: str | None = None, available_now: bool = True,
                            processing_time: str = "1 minute"):
    """Start the streaming query; returns the StreamingQuery.

    ``raw_dir`` holds raw-visit parquet files (schema.RAW_VISITS, optionally
    partitioned by StartDate). ``available_now=True`` processes what is
    there and stops (a scheduled run); otherwise it polls every
    ``processing_time``.
    """
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "visit-maintenance")
    stream = spark.readStream.schema(RAW_VISITS).parquet(raw_dir)
    writer = (stream.writeStream
              .foreachBatch(_rebuild_days(spark, raw_dir, visits_dir, start_date, end_date, list(goals)))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
