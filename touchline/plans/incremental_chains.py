"""The chain table kept by user buckets, of which only those of changed users are rebuilt.

    store = ChainStore(spark, "s3://.../chains_by_user", "2020-07-01", "2020-09-30", [-1], max_gap=d, buckets=4096)
    store.build(raw)               # all buckets, one job
    store.refresh(raw, new_rows)   # after late versions, cancel rows or new visits

A user's chains depend on the user's visits alone (the churn gap is given), so after new raw rows only the
users in them can change. Their rows are computed anew from the raw table, the other users of the same buckets
keep their stored rows, and the buckets are replaced by one dynamic overwrite, which moves the new
files in when its job has succeeded. Files of all other buckets are not touched. With another period, goals
or gap, ``build`` again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.chains import chains
from touchline.operators.skew import BLOCK_ROWS, HOT_USER_ROWS, hot_user_lists
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits
from touchline.session import checkpointed, delete_paths, recorded
from touchline.sources.publish import replace_folder

USER = ["CounterID", "UserID"]
BUCKET = "bucket"


def user_bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*USER), F.lit(buckets)).cast("int")


class ChainStore:
    def __init__(self, spark: SparkSession, path: str, start_date: str, end_date: str, goals: Sequence[int],
                 max_gap: float | None, buckets: int, hot_user_rows: int | None = HOT_USER_ROWS,
                 block_rows: int = BLOCK_ROWS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.start_date, self.end_date, self.goals, self.max_gap = start_date, end_date, list(goals), max_gap
        self.hot_user_rows, self.block_rows = hot_user_rows, block_rows

    def _chains(self, raw: DataFrame) -> DataFrame:
        visits = checkpointed(latest_live_visits(raw, self.start_date, self.end_date, self.goals), "store-visits")
        hot = hot_user_lists(visits.select(*USER), self.hot_user_rows)[1] if self.hot_user_rows is not None else None
        t = touches(visits, self.max_gap, hot_user_rows=self.hot_user_rows, block_rows=self.block_rows, hot=hot)
        rows = chains(t, self.max_gap, self.end_date, self.hot_user_rows, self.block_rows, hot=hot)
        return rows.withColumn(BUCKET, user_bucket_of(self.buckets))

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """Range partitions of (bucket, user, chain): few files a bucket, and a hot user is split at sampled bounds."""
        keys = [BUCKET, *USER, "chain", "pos"]
        return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def build(self, raw: DataFrame) -> None:
        """All buckets from all raw rows; the folder is replaced when the job has succeeded."""
        passing: list[str] = []
        with recorded(passing):
            rows = self._chains(raw)
            replace_folder(self._laid_out(rows), self.path, [BUCKET])
        delete_paths(self.spark, passing)

    def read(self) -> DataFrame:
        """The chain table (without the bucket)."""
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def refresh(self, raw: DataFrame, new_rows: DataFrame) -> list[int]:
        """Bring the store to the state of ``raw`` after ``new_rows`` were added to it; returns the buckets
        that were replaced (the only list that reaches the driver: at most one number a bucket)."""
        passing: list[str] = []
        with recorded(passing):
            changed = new_rows.select("CounterID", F.col("UserIDHash").alias("UserID")).distinct()
            changed = checkpointed(changed.withColumn(BUCKET, user_bucket_of(self.buckets)), "store-changed")
            touched = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())
            if touched:
                users = changed.select("CounterID", F.col("UserID").alias("UserIDHash"))
                fresh = self._chains(raw.join(users, ["CounterID", "UserIDHash"], "left_semi"))
                stored = self.spark.read.parquet(self.path)
                kept = (stored.where(F.col(BUCKET).isin(touched))      # prunes to these buckets' files
                        .join(changed.select(*USER), USER, "left_anti"))
                # written apart first: the overwrite replaces files that this reads
                rows = checkpointed(fresh.unionByName(kept.select(*fresh.columns)), "store-buckets")
                left = {r[0] for r in rows.select(BUCKET).distinct().collect()}
                (self._laid_out(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(BUCKET).parquet(self.path))
                # a dynamic overwrite leaves buckets alone that have no rows any more
                delete_paths(self.spark, [f"{self.path}/{BUCKET}={b}" for b in touched if b not in left])
        delete_paths(self.spark, passing)
        return touched
