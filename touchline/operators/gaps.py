"""Gaps between a user's successive visits and their quantile (the churn gap D)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.time import epoch_seconds
from touchline.operators.skew import AUTO, BLOCK_ROWS, HOT_USER_ROWS, split_hot
from touchline.sources.sampling import user_sample

# Coarse histogram bucket width (seconds) of the two-pass exact quantile.
_COARSE = 4096


def visit_gaps(visits: DataFrame, by=("UserID",), hot_user_rows: int | None = HOT_USER_ROWS,
               block_rows: int = BLOCK_ROWS, hot=AUTO) -> DataFrame:
    """One row per visit that has a predecessor: ``gap`` = seconds since the previous visit.

    ``by`` is the user key. The churn threshold groups by UserID only, while
    chains group by (CounterID, UserID); both are kept on purpose.
    Hot users are cut into blocks: gaps inside a block come from a per-block
    window, the gap across a block boundary from the blocks' first and last
    times (one row per block).
    """
    t = visits.select(*by, "VisitID", epoch_seconds("UTCStartTime").alias("ts"))
    normal, hot = split_hot(t, list(by), hot_user_rows, block_rows, hot=hot)
    w = Window.partitionBy(*by).orderBy("ts")
    gaps = (normal.select(*by, (F.col("ts") - F.lag("ts").over(w)).alias("gap"))
            .where(F.col("gap").isNotNull()))
    if hot is None:
        return gaps
    wb = Window.partitionBy(*by, "blk").orderBy("ts")
    inner = (hot.select(*by, (F.col("ts") - F.lag("ts").over(wb)).alias("gap"))
             .where(F.col("gap").isNotNull()))
    ends = hot.groupBy(*by, "blk").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    across = (ends.select(*by, (F.col("first_ts") - F.lag("last_ts").over(
                  Window.partitionBy(*by).orderBy("blk"))).alias("gap"))
              .where(F.col("gap").isNotNull()))
    return gaps.unionByName(inner).unionByName(across)


def gap_histogram(gaps: DataFrame) -> DataFrame:
    """gap -> number of gaps; its size is bounded by the period length in seconds, not by rows."""
    return gaps.groupBy("gap").agg(F.count(F.lit(1)).alias("n"))


def exact_quantile(hist: DataFrame, p: float) -> float | None:
    """Exact quantile with linear interpolation between order statistics.

    Position (N - 1) * p, as ``percentile`` in Spark and ``quantile_cont`` in
    SQL engines. Works from the (value, count) histogram in two bounded
    steps: coarse buckets of width 4096 (at most period/4096 rows reach the
    driver), then the exact values of at most two buckets (at most 2 * 4096
    rows). No task or driver ever holds the gap list.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    coarse = (hist.groupBy(F.floor(F.col("gap") / _COARSE).alias("b"))
              .agg(F.sum("n").alias("n")).orderBy("b").collect())
    total = sum(r["n"] for r in coarse)
    if total == 0:
        return None
    pos = (total - 1) * p
    lo_rank, hi_rank = math.floor(pos), math.ceil(pos)

    def bucket_of(rank):
        seen = 0
        for r in coarse:
            if rank < seen + r["n"]:
                return r["b"], seen
            seen += r["n"]
        raise AssertionError("rank out of range")

    wanted = {}
    for rank in (lo_rank, hi_rank):
        b, before = bucket_of(rank)
        wanted[b] = before
    fine = (hist.where(F.floor(F.col("gap") / _COARSE).isin(list(wanted)))
            .select(F.floor(F.col("gap") / _COARSE).alias("b"), "gap", "n").collect())

    def value_at(rank):
        b, before = bucket_of(rank)
        seen = before
        for r in sorted((r for r in fine if r["b"] == b), key=lambda r: r["gap"]):
            if rank < seen + r["n"]:
                return float(r["gap"])
            seen += r["n"]
        raise AssertionError("rank out of range")

    lo_v = value_at(lo_rank)
    if hi_rank == lo_rank:
        return lo_v
    hi_v = value_at(hi_rank)
    return lo_v + (pos - lo_rank) * (hi_v - lo_v)


def gap_quantile(visits: DataFrame, p: float = 0.95, sample_denominator: int | None = None,
                 sample_method: str = "hash", hot_user_rows: int | None = HOT_USER_ROWS,
                 block_rows: int = BLOCK_ROWS, hot=AUTO) -> float | None:
    """The churn threshold D: the p-quantile of gaps between successive visits of a user.

    Exact on all users by default; ``sample_denominator=n`` keeps 1/n of the
    users (whole users). Returns None when no user has two visits.
    """
    if sample_denominator:
        visits = user_sample(visits, sample_denominator, method=sample_method)
    # the histogram has at most one row per distinct gap (bounded by the
    # period in seconds); keep it for the two passes instead of recomputing
    hist = gap_histogram(visit_gaps(visits, hot_user_rows=hot_user_rows, block_rows=block_rows, hot=hot)
                         ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return exact_quantile(hist, p)
    finally:
        hist.unpersist()
