"""Hand-computed tiny cases (FIXTURES.md F1, F1b): every report column pinned."""

import datetime as dt

import pytest

from touchline.operators import attribution, positions, reports
from touchline.operators.chains import chains, history_of
from touchline.operators.touches import touches
from touchline.plans.fixture import fixture_names
from tests.helpers import BASE, by_code, visits_df

F1 = [  # visit_id, t, code, conv, rev, duration
    (1, 0, "2_2", 0, 0, 60),
    (2, 50, "3_1_2", 0, 0, 0),
    (3, 100, "0", 1, 10, 30),
    (4, 500, "0", 1, 5, 200),
    (5, 550, "2_2", 0, 0, 0),
]
D = 100.0


@pytest.fixture(scope="module")
def f1(spark):
    t = touches(visits_df(spark, F1), D)
    return t, positions.source_measures(t)


def test_segments_and_positions(f1):
    t, _ = f1
    rows = sorted((r.VisitID, r.seg, r.pos, r.seg_len) for r in t.collect())
    assert rows == [(1, 0, 1, 3), (2, 0, 2, 3), (3, 0, 3, 3), (4, 1, 1, 2), (5, 1, 2, 2)]


def test_simple_attributions(f1):
    _, m = f1
    rep = by_code(reports.simple_attributions(m))
    exp = {  # code: last(v,c,r) first sig direct linear
        "2_2": [(2, 0, 0), (3, 1, 10), (2, 0, 0), (2, 0, 0), (7 / 3, 1 / 3, 10 / 3)],
        "3_1_2": [(1, 0, 0), (0, 0, 0), (2, 1, 10), (2, 1, 10), (5 / 6, 1 / 3, 10 / 3)],
        "0": [(2, 2, 15), (2, 1, 5), (1, 1, 5), (1, 1, 5), (11 / 6, 4 / 3, 25 / 3)],
    }
    prefixes = ["LastClick", "FirstClick", "LastSignClick", "LastSignDirect", "LinearAttr"]
    assert set(rep) == set(exp)
    for code, models in exp.items():
        for prefix, (v, c, r) in zip(prefixes, models):
            got = rep[code]
            assert got[f"{prefix}Visits"] == pytest.approx(v), (code, prefix)
            assert got[f"{prefix}Convs"] == pytest.approx(c), (code, prefix)
            assert got[f"{prefix}Revenue"] == pytest.approx(r), (code, prefix)


def test_associated(f1, spark):
    _, m = f1
    rep = by_code(reports.with_names(reports.associated_conversions(m), fixture_names(spark)))
    assert {k: (v["AssociatedVisits"], v["AssociatedConvs"], v["AssociatedRevenue"]) for k, v in rep.items()} == {
        "2_2": (4, 1, 10.0), "3_1_2": (2, 1, 10.0), "0": (3, 2, 15.0)}
    assert rep["0"]["SourceName"] == "Direct"


def test_position_metrics(f1):
    _, m = f1
    rep = by_code(positions.position_metrics(m))
    exp = {
        "in_chain_perc_total": {"2_2": 4 / 9, "3_1_2": 2 / 9, "0": 3 / 9},
        "in_conv_chains_perc_total": {"2_2": 1 / 4, "3_1_2": 1 / 4, "0": 2 / 4},
        "unique_chains_perc": {"2_2": 4 / 5, "3_1_2": 2 / 5, "0": 3 / 5},
        "unique_conv_chains_perc": {"2_2": 1 / 2, "3_1_2": 1 / 2, "0": 2 / 2},
        "first_touch_2plus": {"2_2": 2 / 3, "3_1_2": 0, "0": 1 / 3},
        "first_touch_conv_2plus": {"2_2": 1, "3_1_2": 0, "0": 0},
        "first_touch_total": {"2_2": 3 / 5, "3_1_2": 0, "0": 2 / 5},
        "first_touch_conv_total": {"2_2": 1 / 2, "3_1_2": 0, "0": 1 / 2},
        "mid_touch_3plus": {"2_2": 0, "3_1_2": 0, "0": 0},
        "mid_touch_conv_3plus": {"2_2": 0, "3_1_2": 0, "0": 0},
        "last_touch_2plus": {"2_2": 1 / 3, "3_1_2": 1 / 3, "0": 1 / 3},
        "last_touch_conv_2plus": {"2_2": 0, "3_1_2": 0, "0": 1},
        "last_touch_total": {"2_2": 2 / 5, "3_1_2": 1 / 5, "0": 2 / 5},
        "last_touch_conv_total": {"2_2": 0, "3_1_2": 0, "0": 1},
    }
    for col, per_code in exp.items():
        for code, v in per_code.items():
            assert rep[code][col] == pytest.approx(v), (col, code)


def test_chain_table_and_visits_ahead(f1, spark):
    t, _ = f1
    c = chains(t, D, "2024-01-10")
    got = sorted((r.chain, r.pos, r.VisitID, r.EventType, r.VisitsSum, r.VisitsSumAfterDuration)
                 for r in c.collect())
    assert got == [
        (0, 1, 1, "2_VISIT", 2, 1), (0, 2, 2, "2_VISIT", 1, 1), (0, 3, 3, "2_VISIT", 0, 0),
        (0, 4, 0, "0_NULL", 0, 0),
        (1, 1, 4, "2_VISIT", 1, 0), (1, 2, 5, "2_VISIT", 0, 0), (1, 3, 0, "0_NULL", 0, 0),
    ]
    markers = {(r.chain, r.pos): r.UTCStartTime for r in c.collect() if r.EventType == "0_NULL"}
    assert markers[(0, 4)] - BASE == dt.timedelta(seconds=200)   # 100 + int(D)
    assert markers[(1, 3)] - BASE == dt.timedelta(seconds=650)   # trailing: 550 + int(D)
    # the trailing marker falls outside a period that ended before it
    assert chains(t, D, "2024-01-09").count() == 6


def test_history_of_a_chain(f1):
    t, _ = f1
    c = chains(t, D, "2024-01-10")
    h = history_of(c, 1, 1, 0, 3).collect()
    assert [r.VisitID for r in h] == [1, 2, 3]
    assert [r.SourceCode for r in h] == ["2_2", "3_1_2", "0"]
    assert [r.EventType for r in history_of(c, 1, 1, 1, 3).collect()] == ["2_VISIT", "2_VISIT", "0_NULL"]


def test_middle_touch_f1b(spark):
    rows = [(1, 0, "1", 0), (2, 1, "4", 0), (3, 2, "5", 0), (4, 3, "4", 1), (5, 4, "7", 1)]
    t = touches(visits_df(spark, rows), 100.0)
    m = positions.source_measures(t)
    mid = by_code(positions.position_part(m, "pos_middle"))
    assert {k: (v["mid_touch_3plus"], v["mid_touch_conv_3plus"]) for k, v in mid.items()} == {
        "4": (1.0, 1.0), "5": (1.0, 1.0)}
    full = by_code(positions.position_metrics(m))
    assert full["1"]["mid_touch_3plus"] == 0 and full["7"]["mid_touch_3plus"] == 0


def test_stand_alone_parts_agree_with_merged(f1):
    t, m = f1
    merged = by_code(reports.simple_attributions(m))
    for fn, prefix in [(attribution.attr_last_click, "LastClick"), (attribution.attr_first_click, "FirstClick"),
                       (attribution.attr_last_significant, "LastSignClick"),
                       (attribution.attr_last_direct, "LastSignDirect")]:
        for code, r in by_code(fn(t)).items():
            assert r[f"{prefix}Visits"] == merged[code][f"{prefix}Visits"]
            assert r[f"{prefix}Revenue"] == merged[code][f"{prefix}Revenue"]
    lin = by_code(attribution.attr_linear(t))
    for code, r in lin.items():
        assert r["LinearAttrVisits"] == pytest.approx(merged[code]["LinearAttrVisits"])


def test_facade_top_reports(spark):
    from touchline.plans.analytics import ChainAnalytics
    from touchline.schema import RAW_VISITS
    raw = spark.createDataFrame([], RAW_VISITS)
    ca = ChainAnalytics(spark, raw, "2024-01-01", "2024-01-31", max_gap=D)
    ca._visits = visits_df(spark, F1)
    simple = ca.top_report("simple").collect()
    assert simple[0].SourceCode == "0" and simple[0].LastClickRevenue == 15.0
    assoc = ca.top_report("associated").collect()
    assert [r.AssociatedConvs for r in assoc] == ["2", "1", "1"]
    chains_view = ca.top_report("chains").collect()
    assert chains_view[0].unique_chains_perc == "80.00%"
    ca.release()


def test_debug_prints_the_plan(spark, capsys):
    from touchline.plans.analytics import ChainAnalytics
    from touchline.schema import RAW_VISITS
    ca = ChainAnalytics(spark, spark.createDataFrame([], RAW_VISITS), "2024-01-01", "2024-01-31", max_gap=D)
    ca._visits = visits_df(spark, F1)
    ca.associated_conversions(debug=True)
    assert "Physical Plan" in capsys.readouterr().out
    ca.release()
