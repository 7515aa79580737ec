"""Hot keys: users too large for one window task, and their time blocks.

Every per-user window puts one user's rows in one task. A key holding a
large share of all rows (a crawler, a shared device id) would make that one
task the whole job, so such users are cut into blocks of consecutive rows
in time order, about ``block_rows`` each, and processed per (user, block),
with the state that crosses a block boundary carried through small
per-block summaries (see ``touches._credits_blocked``).

The hot-user list has at most (rows / threshold) entries -- each entry
stands for more than ``threshold`` rows. It is collected, and broadcast when
its measured size is within MAX_BROADCAST_KEYS.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import checkpointed

# A user with more visits than this in the period takes the blocked path.
HOT_USER_ROWS = 2_000_000
# Target rows per block of a hot user.
BLOCK_ROWS = 500_000
# Broadcast the hot-key list only up to this many keys (checked after collecting it).
MAX_BROADCAST_KEYS = 200_000


def hot_keys(df: DataFrame, key: Sequence[str], threshold: int, ts: str = "ts") -> DataFrame:
    """Keys with more than ``threshold`` rows, with their row count and time span.

    One aggregation with map-side partial aggregation, so a hot key costs
    one partial record per task, not a task of its own.
    """
    return (df.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
            .where(F.col("_n") > threshold))


def rows_before(counts: DataFrame, key: Sequence[str], pos: str = "ts", count: str = "_c",
                bucket: int = 3600) -> DataFrame:
    """Add ``_before``: the key's total ``count`` at positions below ``pos``.

    ``counts`` has one row per (key, pos) (e.g. rows per second). Two levels keep
    every window small: running totals over buckets of ``bucket`` positions
    (one row per bucket and key: 8,760 hours in a year) and running sums inside
    a bucket (at most ``bucket`` rows), added together.
    """
    key = list(key)
    b = counts.withColumn("_b", F.floor(F.col(pos) / F.lit(bucket)).cast("long"))
    per_bucket = b.groupBy(*key, "_b").agg(F.sum(count).alias("_bt"))
    carry = per_bucket.select(*key, "_b", F.coalesce(F.sum("_bt").over(
        Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_cb"))
    inside = F.coalesce(F.sum(count).over(
        Window.partitionBy(*key, "_b").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (b.select("*", inside.alias("_ib")).join(carry, key + ["_b"], "inner")
            .select(*counts.columns, (F.col("_cb") + F.col("_ib")).alias("_before")))


def hot_key_list(df: DataFrame, key: Sequence[str], threshold: int | None,
                 ts: str = "ts") -> DataFrame | None:
    """The hot keys (at most rows / threshold of them), or None when there are none.

    At most MAX_BROADCAST_KEYS + 1 keys are collected: up to MAX_BROADCAST_KEYS
    the list is broadcast, beyond that it is stored once and shuffle-joined.
    """
    if threshold is None:
        return None
    found = hot_keys(df, key, threshold, ts)
    rows = found.limit(MAX_BROADCAST_KEYS + 1).collect()   # never more than this reaches the driver
    if not rows:
        return None
    if len(rows) > MAX_BROADCAST_KEYS:
        return checkpointed(found.select(*key), "hot-keys")     # too many to broadcast: stored, shuffle-joined
    return F.broadcast(df.sparkSession.createDataFrame(rows, found.schema).select(*key))


AUTO = "auto"


def hot_user_lists(visits_ts: DataFrame, threshold: int | None,
                   counter: str = "CounterID", user: str = "UserID"):
    """(hot UserIDs, hot (CounterID, UserID) pairs) from one aggregation, each a frame or None.

    A user is hot for the churn threshold (gaps by user) when all its counters
    together exceed ``threshold``; a (counter, user) pair is hot for chains when
    it alone does. Rows are counted per pair (partial aggregation), summed per
    user over its few counters, and at most MAX_BROADCAST_KEYS + 1 candidates
    reach the driver; beyond that both lists are stored once and shuffle-joined.
    """
    if threshold is None:
        return None, None
    pairs = visits_ts.groupBy(counter, user).agg(F.count(F.lit(1)).alias("_n"))
    pairs = pairs.withColumn("_un", F.sum("_n").over(Window.partitionBy(user)))
    found = pairs.where((F.col("_n") > threshold) | (F.col("_un") > threshold))
    rows = found.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not rows:
        return None, None
    if len(rows) > MAX_BROADCAST_KEYS:
        found = checkpointed(found, "hot-keys")
        return (found.where(F.col("_un") > threshold).select(user).distinct(),
                found.where(F.col("_n") > threshold).select(counter, user))
    spark = visits_ts.sparkSession
    users = sorted({r[user] for r in rows if r["_un"] > threshold})
    hot_pairs = sorted({(r[counter], r[user]) for r in rows if r["_n"] > threshold})
    users_df = F.broadcast(spark.createDataFrame([(u,) for u in users], f"{user} long")) if users else None
    pairs_df = (F.broadcast(spark.createDataFrame(hot_pairs, f"{counter} long, {user} long"))
                if hot_pairs else None)
    return users_df, pairs_df


def resolve_hot(df: DataFrame, key: Sequence[str], threshold: int | None, hot=AUTO,
                ts: str = "ts") -> DataFrame | None:
    """``hot`` given by the caller (a key frame, or None for "no hot keys"), or found now."""
    if isinstance(hot, str):
        return hot_key_list(df, key, threshold, ts)
    return hot.select(*key) if hot is not None else None


#: Pieces that one second of a hot key can be cut into, of about as many rows each (by quantiles of its ids).
SECOND_PIECES = 512


def split_hot(df: DataFrame, key: Sequence[str], threshold: int | None, block_rows: int, ts: str = "ts",
              order: str = "VisitID", hot=AUTO) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with a block number ``blk``).

    The hot keys are found with one small action; their list has at most rows / threshold entries. When
    there are none the plan has no blocked branch at all.

    Blocks follow the row count, not the clock, in (``ts``, ``order``) order: rows are counted per (key,
    second), and a second with more than ``block_rows`` rows is cut at quantiles of ``order``, however its
    ids are spread; the pieces are counted too; ``rows_before`` gives each of these pieces the number of earlier rows, and
    ``blk = earlier_rows div block_rows``. A block therefore holds ``block_rows`` rows plus at most one
    piece's, however bursty the key is, and block order is time order.
    """
    hot = resolve_hot(df, key, threshold, hot, ts)
    if hot is None:
        return df, None
    normal = df.join(hot, list(key), "left_anti")
    hot_rows = df.join(hot, list(key), "left_semi")
    per_second = checkpointed(hot_rows.groupBy(*key, ts).agg(F.count(F.lit(1)).alias("_c")), "hot-seconds")
    crowded = per_second.where(F.col("_c") > block_rows).drop("_c")
    if crowded.head(1):
        quantiles = [i / SECOND_PIECES for i in range(1, SECOND_PIECES)]
        bounds = (hot_rows.join(crowded, [*key, ts], "left_semi").groupBy(*key, ts)
                  .agg(F.percentile_approx(order, quantiles).alias("_bounds")))
        piece = F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col(order))), F.lit(0))
        pieces = (hot_rows.join(bounds, [*key, ts], "left")
                  .withColumn("_at", F.col(ts) * SECOND_PIECES + F.when(F.col("_bounds").isNull(), 0).otherwise(piece))
                  .drop("_bounds"))
        counts = pieces.groupBy(*key, "_at").agg(F.count(F.lit(1)).alias("_c"))
    else:       # every second is one piece
        pieces = hot_rows.withColumn("_at", F.col(ts) * SECOND_PIECES)
        counts = per_second.select(*key, (F.col(ts) * SECOND_PIECES).alias("_at"), "_c")
    blocks = rows_before(counts, key, "_at", bucket=3600 * SECOND_PIECES).select(
        *key, "_at", F.floor(F.col("_before") / F.lit(block_rows)).cast("long").alias("blk"))
    # several plans read these rows: stored, they are cut once
    return normal, checkpointed(pieces.join(blocks, [*key, "_at"], "inner").drop("_at"), "hot-blocks")
