"""Collapse versioned, signed raw visit rows into one live row per visit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.goals import conversions_expr, revenue_expr
from touchline.functions.source_code import source_code
from touchline.functions.time import epoch_ntz

VISIT_KEY = ["CounterID", "UserID", "VisitID", "StartDate"]


def latest_live_visits(raw: DataFrame, start_date, end_date,
                       goals: Sequence[int] = (-1,)) -> DataFrame:
    """raw visits -> schema.VISITS.

    * rows with StartDate in [start_date, end_date] (pushed to the scan);
    * per (CounterID, UserID, VisitID, StartDate) the columns of the row with
      the highest VisitVersion, taken together from one row;
    * a visit is live when the sum of its Signs is positive;
    * traffic-source fields come from the first TrafficSource element with
      Model = 1, or type defaults (0, 1970-01-01) when there is none.

    One hash aggregation on the visit key; partial aggregation runs before
    the shuffle, and the key is never skewed (one visit's versions).
    """
    ts1 = F.get(F.filter("TrafficSource", lambda t: t["Model"] == 1), 0)
    z = lambda c, d=0: F.coalesce(ts1[c], F.lit(d))
    fields = [
        F.col("UTCStartTime"),
        F.coalesce(ts1["StartTime"], epoch_ntz()).alias("StartTime"),
        F.col("Duration").cast("long").alias("Duration"),
        z("ID").cast("int").alias("TraficSourceID"),
        z("SearchEngineID").cast("int").alias("SearchEngineID"),
        z("AdvEngineID").cast("int").alias("AdvEngineID"),
        z("SocialSourceNetworkID").cast("int").alias("SocialSourceNetworkID"),
        z("ClickBannerID").cast("long").alias("ClickBannerID"),
        z("ClickTargetType").cast("int").alias("ClickTargetType"),
        z("RecommendationSystemID").cast("int").alias("RecommendationSystemID"),
        z("MessengerID").cast("int").alias("MessengerID"),
        conversions_expr(goals).alias("Conversions"),
        revenue_expr(goals).cast("double").alias("Revenue"),
    ]
    names = ["UTCStartTime", "StartTime", "Duration", "TraficSourceID", "SearchEngineID", "AdvEngineID",
             "SocialSourceNetworkID", "ClickBannerID", "ClickTargetType", "RecommendationSystemID",
             "MessengerID", "Conversions", "Revenue"]
    # (VisitVersion, Sign) as one LONG: unique per row of a visit, so every
    # column is taken from the same (latest) row; fixed-width aggregation
    # buffers keep this a hash aggregation with map-side partial aggregation.
    version_key = F.col("VisitVersion") * 2 + (F.col("Sign") > 0).cast("long")
    rows = (raw.where(F.col("StartDate").between(F.lit(start_date).cast("date"),
                                                 F.lit(end_date).cast("date")))
            .select("CounterID", F.col("UserIDHash").alias("UserID"), "VisitID", "StartDate",
                    version_key.alias("_version"), "Sign", *fields))
    collapsed = rows.groupBy(*VISIT_KEY).agg(
        *[F.max_by(n, "_version").alias(n) for n in names],
        F.sum("Sign").alias("signs"),
    )
    return collapsed.where(F.col("signs") > 0).select(*VISIT_KEY, *names)


def with_source_code(visits: DataFrame, literal_banner_column: bool = False) -> DataFrame:
    """Add SourceCode.

    ``literal_banner_column=True`` reproduces the source system's column mix-up
    in which the banner id slot held RecommendationSystemID.
    """
    banner = "RecommendationSystemID" if literal_banner_column else "ClickBannerID"
    return visits.withColumn("SourceCode", source_code(banner=banner))
