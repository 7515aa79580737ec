"""Raw visits derived from the driver's ``events`` table (test fixture F2).

The test data has no visit table, so each event becomes one visit with
several versions and cancel rows, two traffic-source models (a real one and
a decoy), purchases and goals. Every value is a pure function of the event
row, so the same rows can be produced by the SQL oracle. The lists below are
the fixture's own design (FIXTURES.md, F2).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.time import ntz_from_seconds
from touchline.schema import SOURCE_NAMES

# Fixture values (F2): lookup lists indexed from zero.
SOURCE_IDS = [0, 1, 2, 2, 3, 3, 3, 3, 8, 9, 10, -1, 4, 5, 7, 11]
ADV_ENGINES = [1, 1, 1, 2, 12, 17, 37]
CLICK_TARGETS = [0, 2, 3]
LOCAL_OFFSET_SECONDS = 3 * 3600
DECOY_OFFSET_SECONDS = -86400


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def raw_visits_from_events(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> raw visits (schema.RAW_VISITS)."""
    eid, k = F.col("event_id"), F.col("k")
    base = events.select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.lit(1) + F.col("event_id") % 3).alias("nv"),
        F.unix_timestamp("ts").alias("t0"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )
    real = F.struct(
        F.lit(1).alias("Model"),
        ntz_from_seconds(F.col("t0") + LOCAL_OFFSET_SECONDS).alias("StartTime"),
        _pick(SOURCE_IDS, (eid * 7 + k) % 16).alias("ID"),
        (1 + k % 5).alias("SearchEngineID"),
        _pick(ADV_ENGINES, k % 7).alias("AdvEngineID"),
        (1 + k % 6).alias("SocialSourceNetworkID"),
        F.when(k % 2 == 0, 1000 + k).otherwise(0).cast("long").alias("ClickBannerID"),
        _pick(CLICK_TARGETS, k % 3).alias("ClickTargetType"),
        (2 + k % 3).alias("RecommendationSystemID"),
        (1 + k % 5).alias("MessengerID"),
    )
    decoy = F.struct(
        F.lit(2).alias("Model"),
        ntz_from_seconds(F.col("t0") + DECOY_OFFSET_SECONDS).alias("StartTime"),
        F.lit(1).alias("ID"), F.lit(9).alias("SearchEngineID"), F.lit(3).alias("AdvEngineID"),
        F.lit(0).alias("SocialSourceNetworkID"), F.lit(0).cast("long").alias("ClickBannerID"),
        F.lit(9).alias("ClickTargetType"), F.lit(0).alias("RecommendationSystemID"),
        F.lit(0).alias("MessengerID"),
    )
    traffic = (F.when(eid % 31 == 0, F.array(decoy))
               .when(eid % 2 == 0, F.array(real, decoy))
               .otherwise(F.array(decoy, real)))
    first_rev = (F.when(k == 1, F.lit(-5000000)).when(k == 2, F.lit(200000000000))
                 .otherwise(F.col("cents") * 10000)).cast("long")
    p1 = F.struct(F.concat(F.lit("p"), eid.cast("string")).alias("ID"), first_rev.alias("Revenue"))
    p2 = F.struct(F.concat(F.lit("q"), eid.cast("string")).alias("ID"),
                  F.lit(1500000).cast("long").alias("Revenue"))
    empty_p = F.filter(F.array(p1), lambda _: F.lit(False))  # typed empty array
    purchases = (F.when((F.col("event_type") == "purchase") & (k % 7 == 0), F.array(p1, p2))
                 .when(F.col("event_type") == "purchase", F.array(p1))
                 .otherwise(empty_p))
    price = (F.col("cents") * 10).cast("long")
    g = lambda i: F.struct(F.lit(i).cast("long").alias("ID"), price.alias("Price"))
    goals = (F.when(F.col("event_type") == "signup", F.array(g(10)))
             .when(F.col("event_type") == "click", F.array(g(20), g(20)))
             .when(F.col("event_type") == "purchase", F.array(g(10), g(30)))
             .otherwise(F.filter(F.array(g(0)), lambda _: F.lit(False))))
    versions = base.select(
        "*",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("nv"))).alias("ver"),
    )
    signed = versions.select(
        "*",
        F.explode(F.when((F.col("ver") < F.col("nv")) | (eid % 23 == 0), F.array(F.lit(1), F.lit(-1)))
                  .otherwise(F.array(F.lit(1)))).alias("Sign"),
    )
    t0 = ntz_from_seconds(F.col("t0"))
    return signed.select(
        F.when(eid % 5 == 0, 2).otherwise(1).cast("long").alias("CounterID"),
        F.col("user_id").cast("long").alias("UserIDHash"),
        (eid + 1).cast("long").alias("VisitID"),
        F.col("ver").cast("long").alias("VisitVersion"),
        F.col("Sign").cast("int").alias("Sign"),
        F.to_date(t0).alias("StartDate"),
        t0.alias("UTCStartTime"),
        F.when(eid % 97 == 0, F.lit(200000))
         .otherwise((k * 13) % 1800 + (F.col("nv") - F.col("ver"))).cast("long").alias("Duration"),
        traffic.alias("TrafficSource"),
        purchases.alias("EPurchase"),
        goals.alias("Goals"),
    )


def fixture_name_rows() -> list[tuple[str, str]]:
    """The fixture's own source labels; some codes are left out on purpose."""
    path = os.path.join(os.path.dirname(__file__), "fixture_names.tsv")
    with open(path, encoding="utf-8") as f:
        lines = [line.rstrip("\n") for line in f]
    return [tuple(line.split("\t", 1)) for line in lines[1:] if line]


def fixture_names(spark: SparkSession) -> DataFrame:
    """The labels as a frame made on the driver: executors need no file of this package."""
    return spark.createDataFrame(fixture_name_rows(), SOURCE_NAMES)
