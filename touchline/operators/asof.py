"""As-of lookup in bounded pieces: for each query position, the value of the
last point at or before it (same key).

Points and queries are cut into buckets of ``bucket`` consecutive positions;
a window per (key, bucket) answers queries that have a point earlier in their
bucket, and a carry over buckets -- one row per bucket -- answers the rest.
With one point and one query per distinct position, no task holds more than
2 * bucket rows, whatever the key's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_last(points: DataFrame, queries: DataFrame, key: Sequence[str], bucket: int) -> DataFrame:
    """points(key..., pos, value) with distinct (key, pos); queries(key..., pos) distinct.

    Returns (key..., pos, value) for every query; value is NULL when no point
    precedes it. A point at the query's own position counts.
    """
    key = list(key)
    vtype = dict(points.dtypes)["value"]
    pts = points.select(*key, "pos", F.lit(0).alias("kind"), F.col("value"))
    qs = queries.select(*key, "pos", F.lit(1).alias("kind"), F.lit(None).cast(vtype).alias("value"))
    both = pts.unionByName(qs).withColumn("bkt", F.floor(F.col("pos") / F.lit(bucket)).cast("long"))
    w = Window.partitionBy(*key, "bkt").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    local = both.select("*", F.last("value", ignorenulls=True).over(w).alias("local"))
    per_bucket = both.groupBy(*key, "bkt").agg(
        F.max(F.when(F.col("kind") == 0, F.struct(F.col("pos").alias("p"), F.col("value").alias("v"))))
        .alias("last_pt"))
    carry = per_bucket.select(
        *key, "bkt",
        F.last(F.col("last_pt")["v"], ignorenulls=True).over(
            Window.partitionBy(*key).orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    return (local.where(F.col("kind") == 1).join(carry, key + ["bkt"], "inner")
            .select(*key, "pos", F.coalesce(F.col("local"), F.col("carry")).alias("value")))
