"""The visit table stored by user, so that the touch table needs no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.skew import HOT_USER_ROWS, hot_user_lists

USER = ["CounterID", "UserID"]
#: Tasks that write the rows of one hot user.
HOT_WRITERS = 16


def save_visits_by_user(visits: DataFrame, table: str, buckets: int, path: str | None = None,
                        hot_user_rows: int | None = HOT_USER_ROWS) -> None:
    """Cleaned visits as a new catalog table in ``buckets`` buckets of (CounterID, UserID), sorted by user and time.

    Every window over users, and every join or aggregation on them, reads its partitions as they are stored:
    ``touches`` of such a table has no exchange. Choose ``buckets`` so that one fits a task (the number is fixed
    with the table). A bucket is written by one task, but for those with a user of more than ``hot_user_rows`` rows,
    whose rows are dealt to ``HOT_WRITERS`` tasks and files. Rows are read back by ``spark.table``.
    """
    bucket = F.pmod(F.hash(*USER), F.lit(buckets))      # the hash that bucketed tables use
    keys = [bucket]
    hot = hot_user_lists(visits.select(*USER), hot_user_rows)[1] if hot_user_rows is not None else None
    rows = visits
    if hot is not None:
        marked = hot.select(*USER).withColumn("_hot", F.lit(True))
        rows = visits.join(marked, USER, "left")
        keys.append(F.when(F.col("_hot"), F.pmod(F.xxhash64("VisitID"), F.lit(HOT_WRITERS))).otherwise(0))
    rows = rows.repartition(buckets, *keys)
    rows = rows.drop("_hot") if hot is not None else rows
    writer = (rows.write.format("parquet").bucketBy(buckets, *USER)
              .sortBy(*USER, "UTCStartTime", "VisitID"))
    (writer.option("path", path) if path else writer).saveAsTable(table)
