"""The churn threshold from a mergeable state, one part a date.

``daily_gap_state`` keeps of each date a histogram of the gaps inside it and every user's first and last time.
For any period the histogram of all gaps is the sum of its dates' histograms and of the gaps from one date's
last visit to the next date's first: a window over one row a user and date, not over visits. New or changed
dates replace their own rows of the state only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.time import epoch_seconds
from touchline.operators.gaps import exact_quantile, gap_histogram, visit_gaps
from touchline.operators.skew import BLOCK_ROWS, HOT_USER_ROWS

#: Tasks, and files, that a date's state is written by.
FILES_A_DATE = 4


def daily_gap_state(visits: DataFrame, hot_user_rows: int | None = HOT_USER_ROWS,
                    block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(StartDate, gap, n) of the gaps inside dates, and (StartDate, UserID, first_ts, last_ts)."""
    inside = visit_gaps(visits, by=("UserID", "StartDate"), hot_user_rows=hot_user_rows, block_rows=block_rows)
    counted = inside.groupBy("StartDate", "gap").agg(F.count(F.lit(1)).alias("n"))
    ts = epoch_seconds("UTCStartTime")
    ends = visits.groupBy("StartDate", "UserID").agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return counted, ends


def save_gap_state(visits: DataFrame, path: str, hot_user_rows: int | None = HOT_USER_ROWS,
                   block_rows: int = BLOCK_ROWS) -> None:
    """Write the state of ``visits`` below ``path``; it replaces the state of the dates that these visits have, so
    call it with all visits of each date that is new or has changed. Other dates' files are left alone."""
    for part, rows in zip(("inside", "ends"), daily_gap_state(visits, hot_user_rows, block_rows)):
        (rows.repartition("StartDate", F.pmod(F.xxhash64(*rows.columns[1:2]), F.lit(FILES_A_DATE)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("StartDate")
         .parquet(f"{path.rstrip('/')}/{part}"))


def read_gap_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored state, as ``daily_gap_state`` gives it."""
    inside, ends = (spark.read.parquet(f"{path.rstrip('/')}/{part}") for part in ("inside", "ends"))
    return (inside.select("StartDate", "gap", "n"), ends.select("StartDate", "UserID", "first_ts", "last_ts"))


def merged_gap_histogram(inside: DataFrame, ends: DataFrame, start_date, end_date) -> DataFrame:
    """gap -> number of gaps of the period. Raises in its task if a user's dates interleave in time (as with counters
    in several time zones): then gaps are not the sum of their parts, take ``gap_quantile`` of the visits."""
    period = F.col("StartDate").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
    by_user = Window.partitionBy("UserID").orderBy("first_ts", "last_ts", "StartDate")
    gap = F.col("first_ts") - F.lag("last_ts").over(by_user)
    across = (ends.where(period).select(gap.alias("gap")).where(F.col("gap").isNotNull())
              .select(F.when(F.col("gap") < 0, F.raise_error(F.lit("visits of a user's dates interleave")).cast("long"))
                      .otherwise(F.col("gap")).alias("gap")))
    return (inside.where(period).select("gap", "n").unionByName(gap_histogram(across))
            .groupBy("gap").agg(F.sum("n").alias("n")))


def gap_quantile_of_state(inside: DataFrame, ends: DataFrame, start_date, end_date, p: float = 0.95) -> float | None:
    """The exact p-quantile of the gaps of a period, as ``gap_quantile`` gives it for the period's visits."""
    return exact_quantile(merged_gap_histogram(inside, ends, start_date, end_date), p)
