"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them start from the driver's ``events`` table through the raw-visit
adapter (FIXTURES.md F2) and run over the whole table. Period and goals are
the fixture's: 2024-01-02..2024-01-29 (the date filter bites), goals [-1]
unless the name says otherwise. Times are returned as epoch seconds and
dates as ISO text, arrays joined to text, and the linear-attribution
credits (sums of fractions) rounded to 6 places, so that results compare
exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.time import epoch_seconds
from touchline.operators import positions, reports
from touchline.operators.chains import chain_elements, chains, churn_markers, visits_ahead
from touchline.operators.gaps import gap_quantile
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits, with_source_code
from touchline.plans.analytics import ChainAnalytics
from touchline.plans.fixture import fixture_names, raw_visits_from_events
from touchline.sources.raw_visits import normalize_raw_visits

START, END = "2024-01-02", "2024-01-29"
GOALS = [-1]
LINEAR_DIGITS = 6


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_visits_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def analytics(spark: SparkSession, sf_dir: str, goals=GOALS) -> ChainAnalytics:
    return ChainAnalytics(spark, raw(spark, sf_dir), START, END, goals=goals)


def _date(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def _secs(c: str) -> Column:
    return epoch_seconds(c).alias(c)


def _round_linear(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c), LINEAR_DIGITS).alias(c) if c.startswith("LinearAttr")
                       else F.col(c) for c in df.columns])


# -- sources and visits -----------------------------------------------------

def q_raw_visits_signed(spark, sf_dir):
    r = raw(spark, sf_dir)
    return r.select(
        "CounterID", "UserIDHash", "VisitID", "VisitVersion", "Sign", _date("StartDate"),
        _secs("UTCStartTime"), "Duration",
        F.array_join(F.transform("TrafficSource", lambda t: t["Model"].cast("string")), ",").alias("models"),
        F.array_join(F.transform("TrafficSource", lambda t: t["ID"].cast("string")), ",").alias("source_ids"),
        F.array_join(F.transform("TrafficSource", lambda t: F.unix_timestamp(t["StartTime"]).cast("string")),
                     ",").alias("source_times"),
        F.array_join(F.transform("EPurchase", lambda p: p["ID"]), ",").alias("purchase_ids"),
        F.array_join(F.transform("EPurchase", lambda p: p["Revenue"].cast("string")), ",").alias("purchase_revenue"),
        F.array_join(F.transform("Goals", lambda g: g["ID"].cast("string")), ",").alias("goal_ids"),
        F.array_join(F.transform("Goals", lambda g: g["Price"].cast("string")), ",").alias("goal_prices"),
    )


def _visits_out(v: DataFrame) -> DataFrame:
    return v.select(
        "CounterID", "UserID", "VisitID", _date("StartDate"), _secs("UTCStartTime"), _secs("StartTime"),
        "Duration", "TraficSourceID", "SearchEngineID", "AdvEngineID", "SocialSourceNetworkID",
        "ClickBannerID", "ClickTargetType", "RecommendationSystemID", "MessengerID", "Conversions",
        "Revenue")


def q_latest_live_visits(spark, sf_dir):
    return _visits_out(latest_live_visits(raw(spark, sf_dir), START, END, GOALS))


def flat_raw_visits(raw_visits: DataFrame) -> DataFrame:
    """The fixture as the source system exports it: groups as parallel arrays, empty ones NULL, some
    sub-columns not exported."""
    left_out = {("TrafficSource", "MessengerID"), ("Goals", "Price")}
    cols = [F.col(c) for c in raw_visits.columns if c not in ("TrafficSource", "EPurchase", "Goals")]
    for group in ("Goals", "EPurchase", "TrafficSource"):
        for name in reversed(raw_visits.schema[group].dataType.elementType.names):
            if (group, name) not in left_out:
                values = F.col(f"{group}.{name}")
                cols.append(F.when(F.size(group) > 0, values).alias(f"{group}.{name}"))
    return raw_visits.select(*cols)


def q_raw_visits_flat(spark, sf_dir):
    flat = normalize_raw_visits(flat_raw_visits(raw(spark, sf_dir)))
    return _visits_out(latest_live_visits(flat, START, END, GOALS))


def q_visits_null_groups(spark, sf_dir):
    """"No purchase" and "no goal" stored as NULL."""
    r = raw(spark, sf_dir)
    r = r.withColumns({c: F.when(F.size(c) > 0, F.col(c)) for c in ("EPurchase", "Goals")})
    return _visits_out(latest_live_visits(r, START, END, GOALS))


def q_visits_goals_each_visit(spark, sf_dir):
    return _visits_out(latest_live_visits(raw(spark, sf_dir), START, END, []))


def q_visits_goals_list(spark, sf_dir):
    return _visits_out(latest_live_visits(raw(spark, sf_dir), START, END, [10, 20]))


def q_source_code_counts(spark, sf_dir):
    v = with_source_code(latest_live_visits(raw(spark, sf_dir), START, END, GOALS))
    return v.groupBy("SourceCode").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("Conversions").cast("long").alias("conversions"),
        F.countDistinct("CounterID", "UserID").alias("users"))


# -- churn threshold, touches, chains ---------------------------------------

def _threshold_row(spark, d: float | None) -> DataFrame:
    return spark.createDataFrame(
        [(None if d is None else round(d, 6), None if d is None else int(d))],
        "max_gap double, max_gap_seconds long")


def q_gap_quantile(spark, sf_dir):
    ca = analytics(spark, sf_dir)
    return _threshold_row(spark, gap_quantile(ca.visits, 0.95))


def q_gap_quantile_sampled(spark, sf_dir):
    ca = analytics(spark, sf_dir)
    return _threshold_row(spark, gap_quantile(ca.visits, 0.95, sample_denominator=10,
                                              sample_method="modulo"))


def _touches(spark, sf_dir) -> DataFrame:
    """The touch table as a plan: a query reads it once, so it is not kept."""
    return analytics(spark, sf_dir).combine_visits(persist=False)


def _segments_out(t: DataFrame) -> DataFrame:
    # gap is NULL on a user's first visit; 0 there keeps the column integral across engines
    return t.select("CounterID", "UserID", "VisitID", "ts", F.coalesce("gap", F.lit(0)).alias("gap"),
                    "seg", "idx", "pos", "seg_len",
                    "SourceCode", "FirstSource", "LastSignSource", "LastDirectSource")


def q_touches_segments(spark, sf_dir):
    return _segments_out(_touches(spark, sf_dir))


def q_churn_markers(spark, sf_dir):
    ca = analytics(spark, sf_dir)
    return churn_markers(ca.combine_visits(persist=False), ca.visit_gap_threshold(), END, hot=ca.hot_users()).select(
        "CounterID", "UserID", "seg", "ts", "local_ts", "kind")


def _elements_ahead(spark, sf_dir):
    ca = analytics(spark, sf_dir)
    d, hot = ca.visit_gap_threshold(), ca.hot_users()
    return visits_ahead(chain_elements(ca.combine_visits(persist=False), d, END, hot=hot), d, hot=hot)


def q_visits_ahead(spark, sf_dir):
    return _elements_ahead(spark, sf_dir).select("CounterID", "UserID", "VisitID", "EventType", "ts",
                                                 "VisitsSum")


def q_visits_ahead_after_duration(spark, sf_dir):
    return _elements_ahead(spark, sf_dir).select("CounterID", "UserID", "VisitID", "EventType", "ts",
                                                 "Duration", "VisitsSumAfterDuration")


def _chains_out(c: DataFrame) -> DataFrame:
    return c.select(_date("StartDate"), "UserID", "CounterID", "chain", "pos", "VisitID", "SourceCode",
                    _secs("StartTime"), _secs("UTCStartTime"), "EventType", "Duration", "VisitsSum",
                    "VisitsSumAfterDuration", "Conversions", "Revenue")


def _chain_table(ca: ChainAnalytics, **kw) -> DataFrame:
    t = ca.combine_visits(persist=False, credits=False)
    return _chains_out(chains(t, ca.visit_gap_threshold(), END, **kw))


def q_chains_array(spark, sf_dir):
    """The chain table: one row per element with its chain and position (history = rows up to pos)."""
    ca = analytics(spark, sf_dir)
    return _chain_table(ca, hot=ca.hot_users())


def repeated_ids(raw_visits: DataFrame) -> DataFrame:
    """The fixture with visit ids that start again at 1 on every date of a user: an id is unique only
    together with its StartDate."""
    per_date = Window.partitionBy("CounterID", "UserIDHash", "StartDate").orderBy("VisitID")
    return raw_visits.withColumn("VisitID", F.dense_rank().over(per_date).cast("long"))


def q_chains_repeated_ids(spark, sf_dir):
    ca = ChainAnalytics(spark, repeated_ids(raw(spark, sf_dir)), START, END, goals=GOALS)
    return _chain_table(ca, hot=ca.hot_users())


# -- the same through the hot-user path: every user is cut into blocks of a few visits ----------

BLOCKED = {"hot_user_rows": 0, "block_rows": 7}


def q_gap_quantile_blocked(spark, sf_dir):
    return _threshold_row(spark, gap_quantile(analytics(spark, sf_dir).visits, 0.95, **BLOCKED))


def q_touches_blocked(spark, sf_dir):
    ca = analytics(spark, sf_dir)
    return _segments_out(touches(ca.visits, ca.visit_gap_threshold(), **BLOCKED))


def q_chains_blocked(spark, sf_dir):
    return _chain_table(ChainAnalytics(spark, raw(spark, sf_dir), START, END, goals=GOALS, **BLOCKED), **BLOCKED)


# -- attribution --------------------------------------------------------------

def _part(model):
    def q(spark, sf_dir):
        return _round_linear(analytics(spark, sf_dir).attribution_part(model))
    return q


def _measures(spark, sf_dir) -> DataFrame:
    return positions.source_measures(_touches(spark, sf_dir))


def q_simple_attributions(spark, sf_dir):
    m = _measures(spark, sf_dir)
    return _round_linear(reports.with_names(reports.simple_attributions(m), fixture_names(spark)))


def q_associated_conversions(spark, sf_dir):
    m = _measures(spark, sf_dir)
    return reports.with_names(reports.associated_conversions(m), fixture_names(spark))


def _pos(part):
    def q(spark, sf_dir):
        return positions.position_part(_measures(spark, sf_dir), part)
    return q


def q_source_in_chains_metrics(spark, sf_dir):
    m = _measures(spark, sf_dir)
    return reports.with_names(positions.position_metrics(m), fixture_names(spark))


def q_top_associated_report(spark, sf_dir):
    return reports.top_associated(q_associated_conversions(spark, sf_dir))


def q_top_chains_report(spark, sf_dir):
    return reports.top_chains(q_source_in_chains_metrics(spark, sf_dir))


def q_top_conv_chains_report(spark, sf_dir):
    return reports.top_chains(q_source_in_chains_metrics(spark, sf_dir), converting=True)


def q_top_simple_report(spark, sf_dir):
    rep = q_simple_attributions(spark, sf_dir)
    return reports.top_sources_report(rep, "LastClickRevenue", 10)


def _wide_ints(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Return integer columns as BIGINT so result schemas are the same in every engine."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        small = (T.IntegerType, T.ShortType, T.ByteType)
        return df.select(*[F.col(f.name).cast("long").alias(f.name) if isinstance(f.dataType, small)
                           else F.col(f.name) for f in df.schema.fields])
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_visits_signed": q_raw_visits_signed,
    "latest_live_visits": q_latest_live_visits,
    "raw_visits_flat": q_raw_visits_flat,
    "visits_null_groups": q_visits_null_groups,
    "visits_goals_each_visit": q_visits_goals_each_visit,
    "visits_goals_list": q_visits_goals_list,
    "source_code_counts": q_source_code_counts,
    "gap_quantile": q_gap_quantile,
    "gap_quantile_sampled": q_gap_quantile_sampled,
    "touches_segments": q_touches_segments,
    "churn_markers": q_churn_markers,
    "visits_ahead": q_visits_ahead,
    "visits_ahead_after_duration": q_visits_ahead_after_duration,
    "chains_array": q_chains_array,
    "chains_repeated_ids": q_chains_repeated_ids,
    "gap_quantile_blocked": q_gap_quantile_blocked,
    "touches_blocked": q_touches_blocked,
    "chains_blocked": q_chains_blocked,
    "attr_last_click": _part("last_click"),
    "attr_first_click": _part("first_click"),
    "attr_last_significant": _part("last_significant"),
    "attr_last_direct": _part("last_direct"),
    "attr_linear": _part("linear"),
    "attr_associated": _part("associated"),
    "simple_attributions": q_simple_attributions,
    "associated_conversions": q_associated_conversions,
    **{name: _pos(name) for name in positions.POSITION_PARTS},
    "source_in_chains_metrics": q_source_in_chains_metrics,
    "top_associated_report": q_top_associated_report,
    "top_chains_report": q_top_chains_report,
    "top_conv_chains_report": q_top_conv_chains_report,
    "top_simple_report": q_top_simple_report,
}
QUERIES = {name: _wide_ints(fn) for name, fn in _QUERIES.items()}
