"""Distinct users from mergeable sketches, one a date and source, beside the exact counts.

A HyperLogLog sketch has a fixed size however many users it has seen, and the sketch of a union of dates is the
union of their sketches; exact distinct counts cannot be added up over dates. The standard error is about
1.04 / sqrt(2 ** ``LG_K``), 0.8 % here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def daily_user_sketches(visits: DataFrame, by=("StartDate", "SourceCode"), lg_k: int = LG_K) -> DataFrame:
    """One sketch of the (CounterID, UserID) of each group; partial sketches are merged after the shuffle."""
    return visits.groupBy(*by).agg(F.hll_sketch_agg(F.xxhash64("CounterID", "UserID"), F.lit(lg_k)).alias("users"))


def users_by_source(sketches: DataFrame, start_date, end_date) -> DataFrame:
    """SourceCode and the estimated number of distinct users of a period."""
    period = F.col("StartDate").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
    return (sketches.where(period).groupBy("SourceCode")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users")))
