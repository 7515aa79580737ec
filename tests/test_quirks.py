
import datetime as dt

from pyspark.sql import functions as F

from touchline.operators import positions
from touchline.operators.chains import churn_markers
from touchline.operators.gaps import gap_quantile
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits
from touchline.schema import RAW_VISITS
from tests.helpers import BASE, visits_df


def test_q2_direct_click_wildcard(spark):
    # '3_12' matches LIKE '3_1_%' (underscore is a wildcard) and beats a later '3_1'
    t = touches(visits_df(spark, [(1, 0, "3_12"), (2, 10, "3_1")]), 100.0)
    last = {r.VisitID: r.LastDirectSource for r in t.collect()}
    assert last == {1: "3_12", 2: "3_12"}
    t2 = touches(visits_df(spark, [(1, 0, "3_12"), (2, 10, "3_1")]), 100.0, exact_ad_prefix=True)
    assert {r.VisitID: r.LastDirectSource for r in t2.collect()} == {1: "3_12", 2: "3_1"}


def test_old_banner_click_beats_newer_direct(spark):
    t = touches(visits_df(spark, [(1, 0, "3_1_2"), (2, 10, "3_1"), (3, 20, "0")]), 100.0)
    assert {r.VisitID: r.LastDirectSource for r in t.collect()}[3] == "3_1_2"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_VISITS)


def _ts(model, sec=0, tsid=2, se=3):
    return (model, BASE + dt.timedelta(seconds=sec), tsid, se, 0, 0, 0, 0, 0, 0)


def test_q8_missing_model_defaults(spark):
    d = BASE.date()
    rows = [(1, 7, 100, 1, 1, d, BASE, 30, [_ts(2)], [], [])]
    v = latest_live_visits(_raw(spark, rows), "2024-01-01", "2024-12-31", [-1]).first()
    assert v.TraficSourceID == 0 and v.SearchEngineID == 0
    assert v.StartTime == dt.datetime(1970, 1, 1)


def test_model_pick_uses_first_model_1(spark):
    d = BASE.date()
    rows = [(1, 7, 100, 1, 1, d, BASE, 30, [_ts(2, tsid=9), _ts(1, 60, tsid=2, se=4), _ts(1, 90, tsid=3)], [], [])]
    v = latest_live_visits(_raw(spark, rows), "2024-01-01", "2024-12-31", [-1]).first()
    assert (v.TraficSourceID, v.SearchEngineID) == (2, 4)
    assert v.StartTime == BASE + dt.timedelta(seconds=60)


def test_q17_latest_version_from_one_row(spark):
    d = BASE.date()
    rows = [
        (1, 7, 100, 1, 1, d, BASE, 10, [_ts(1, tsid=2)], [("a", 1_000_000)], []),
        (1, 7, 100, 1, -1, d, BASE, 10, [_ts(1, tsid=2)], [("a", 1_000_000)], []),
        (1, 7, 100, 2, 1, d, BASE, 20, [_ts(1, tsid=3)], [("a", 2_000_000), ("b", -5)], []),
        (1, 7, 101, 1, 1, d, BASE, 10, [_ts(1)], [], []),
        (1, 7, 101, 1, -1, d, BASE, 10, [_ts(1)], [], []),   # cancelled: not live
    ]
    v = latest_live_visits(_raw(spark, rows), "2024-01-01", "2024-12-31", [-1]).collect()
    assert len(v) == 1
    r = v[0]
    assert (r.Duration, r.TraficSourceID, r.Conversions, r.Revenue) == (20, 3, 2, 2.0)


def test_revenue_clamp_and_goals(spark):
    d = BASE.date()
    rows = [(1, 7, 100, 1, 1, d, BASE, 10, [_ts(1)],
             [("a", -5), ("b", 200_000_000_000), ("c", 1_234_560)], [(10, 5000), (20, 700), (10, 1)])]
    raw = _raw(spark, rows)
    p = latest_live_visits(raw, "2024-01-01", "2024-12-31", [-1]).first()
    assert (p.Conversions, p.Revenue) == (3, 1.23)
    g = latest_live_visits(raw, "2024-01-01", "2024-12-31", [10]).first()
    assert (g.Conversions, g.Revenue) == (2, 5.0)
    e = latest_live_visits(raw, "2024-01-01", "2024-12-31", []).first()
    assert (e.Conversions, e.Revenue) == (1, 0.0)


def test_date_filter_inclusive(spark):
    rows = [(1, 7, i, 1, 1, (BASE + dt.timedelta(days=i)).date(), BASE + dt.timedelta(days=i), 1, [_ts(1)], [], [])
            for i in range(5)]
    v = latest_live_visits(_raw(spark, rows), (BASE + dt.timedelta(days=1)).date().isoformat(),
                           (BASE + dt.timedelta(days=3)).date().isoformat(), [])
    assert sorted(r.VisitID for r in v.collect()) == [1, 2, 3]


def test_q9_3plus_means_longer_than_3(spark):
    rows = [(1, 0, "1"), (2, 1, "4"), (3, 2, "5")]  # longest chain has 3 elements: no middle chains
    m = positions.source_measures(touches(visits_df(spark, rows), 100.0))
    assert all(r["mid_touch_3plus"] == 0 for r in positions.position_metrics(m).collect())
    assert m.agg(F.max("tot_chains_4")).first()[0] == 0


def test_q13_cut_uses_untruncated_threshold(spark):
    # gap 100 with D = 100.5 is no cut, gap 101 is; markers sit int(D) = 100 s after the visit
    rows = [(1, 0, "1"), (2, 100, "1"), (3, 201, "1")]
    t = touches(visits_df(spark, rows), 100.5)
    assert sorted((r.VisitID, r.seg) for r in t.collect()) == [(1, 0), (2, 0), (3, 1)]
    mk = churn_markers(t, 100.5, "2030-01-01").collect()
    base = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp())
    assert sorted((r.kind, r.ts - base) for r in mk) == [("gap", 200), ("tail", 301)]


def test_q15_threshold_below_one_second(spark):
    # int(D) = 0: a marker has its visit's own second; its place in the chain (pos) still comes after it
    t = touches(visits_df(spark, [(1, 0, "1"), (2, 0, "1"), (3, 7, "1")]), 0.5)
    assert sorted((r.VisitID, r.seg, r.pos) for r in t.collect()) == [(1, 0, 1), (2, 0, 2), (3, 1, 1)]
    assert sorted((r.kind, r.seg, r.pos) for r in churn_markers(t, 0.5, "2030-01-01").collect()) == [
        ("gap", 0, 3), ("tail", 1, 2)]


def test_q16_no_gaps(spark):
    v = visits_df(spark, [(1, 0, "1", 0, 0, 0, 1), (2, 0, "4", 0, 0, 0, 2)])  # two users, one visit each
    assert gap_quantile(v) is None
    t = touches(v, None)
    assert sorted(r.pos for r in t.collect()) == [1, 1]
    assert churn_markers(t, None, "2030-01-01").count() == 0


def test_q5b_marker_local_time_pairs_sorted_ranks(spark):
    # local times are not in UTC order (visit 2 has no model-1 time: 1970)
    rows = [dict(visit_id=1, t=0, code="1", local_offset=3600), dict(visit_id=2, t=10, code="1"),
            dict(visit_id=3, t=500, code="1", local_offset=3600)]
    v = visits_df(spark, rows).withColumn(
        "StartTime", F.when(F.col("VisitID") == 2, F.lit(dt.datetime(1970, 1, 1))).otherwise(F.col("StartTime")))
    t = touches(v, 100.0)
    mk = [r for r in churn_markers(t, 100.0, "2030-01-01").collect() if r.kind == "gap"]
    base = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp())
    # the cut follows the 2nd visit in UTC order; the 2nd smallest local time is visit 1's
    assert len(mk) == 1 and mk[0].local_ts == base + 3600 + 100


def test_significance_and_fallback(spark):
    t = touches(visits_df(spark, [(1, 0, "2_2"), (2, 10, "0"), (3, 20, "4")]), 100.0)
    last = {r.VisitID: r.LastSignSource for r in t.collect()}
    assert last == {1: "2_2", 2: "2_2", 3: "2_2"}
    t2 = touches(visits_df(spark, [(1, 0, "0"), (2, 10, "5")]), 100.0)
    assert {r.VisitID: r.LastSignSource for r in t2.collect()} == {1: "0", 2: "5"}


def test_q1_literal_banner_column(spark):
    # a 3/1 visit without a banner click but with a recommender id: only the literal
    # (column-shifted) form turns it into a 3_1_<type> code
    v = visits_df(spark, [(1, 0, "3_1")]).withColumn("RecommendationSystemID", F.lit(4)) \
        .withColumn("ClickTargetType", F.lit(2))
    assert touches(v, 100.0).first().SourceCode == "3_1"
    assert touches(v, 100.0, literal_banner_column=True).first().SourceCode == "3_1_2"


def test_q6_threshold_gaps_by_user_chains_by_counter(spark):
    from touchline.operators.gaps import visit_gaps
    # user 1: counter 1 at 0 s and 100 s, counter 2 at 50 s
    v = visits_df(spark, [(1, 0, "1", 0, 0, 0, 1, 1), (2, 100, "1", 0, 0, 0, 1, 1), (3, 50, "4", 0, 0, 0, 1, 2)])
    assert sorted(r.gap for r in visit_gaps(v).collect()) == [50, 50]
    t = touches(v, 60.0)  # per counter the gap is 100 > 60: a cut inside counter 1 only
    assert sorted((r.CounterID, r.VisitID, r.seg) for r in t.collect()) == [(1, 1, 0), (1, 2, 1), (2, 3, 0)]


def test_q14_same_second_ties_by_visit_id(spark):
    t = touches(visits_df(spark, [(9, 0, "2_2"), (3, 0, "0"), (5, 0, "1")]), 100.0)
    assert sorted((r.pos, r.VisitID) for r in t.collect()) == [(1, 3), (2, 5), (3, 9)]
    assert {r.VisitID: r.FirstSource for r in t.collect()} == {3: "0", 5: "0", 9: "0"}


def test_q19_significance_of_codes(spark):
    # '1', '7', '11'-style codes are significant; '0', '-1', '4', '5' are not
    t = touches(visits_df(spark, [(1, 0, "7"), (2, 10, "0"), (3, 20, "5"), (4, 30, "1"), (5, 40, "4")]), 100.0)
    assert {r.VisitID: r.LastSignSource for r in t.collect()} == {1: "7", 2: "7", 3: "7", 4: "1", 5: "1"}


def test_q22_revenue_rounds_half_to_even(spark):
    d = BASE.date()
    rows = [(1, 7, 100, 1, 1, d, BASE, 10, [_ts(1)], [("a", 1_125_000)], []),   # 1.125 exactly
            (1, 7, 101, 1, 1, d, BASE, 10, [_ts(1)], [("a", 1_375_000)], [])]   # 1.375 exactly
    v = {r.VisitID: r.Revenue for r in latest_live_visits(_raw(spark, rows), "2024-01-01", "2024-12-31", [-1]).collect()}
    assert v == {100: 1.12, 101: 1.38}
