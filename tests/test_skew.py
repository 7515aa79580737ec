"""The blocked path for hot users gives exactly the plain path's results."""


import pytest
from pyspark.sql import functions as F

from touchline.operators import positions
from touchline.operators.chains import chains
from touchline.operators.gaps import gap_quantile
from touchline.operators.skew import split_hot
from touchline.operators.touches import TOUCH_TYPES, touches
from touchline.operators.visits import latest_live_visits
from tests.helpers import visits_df

COLS = ["VisitID"] + list(TOUCH_TYPES)


def _rows(df):
    return {r["VisitID"]: r.asDict() for r in df.select(*COLS).collect()}


def _assert_same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for c, v in a[k].items():
            if isinstance(v, float):
                assert b[k][c] == pytest.approx(v, rel=1e-9, abs=1e-12), (k, c)
            else:
                assert b[k][c] == v, (k, c, v, b[k][c])


@pytest.fixture(scope="module")
def visits001(raw001):
    return latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1]).cache()


@pytest.mark.parametrize("threshold,block_rows", [(0, 1), (0, 4), (30, 9)])
def test_blocked_equals_plain(visits001, threshold, block_rows):
    d = gap_quantile(visits001)
    plain = _rows(touches(visits001, d, hot_user_rows=None))
    blocked = _rows(touches(visits001, d, hot_user_rows=threshold, block_rows=block_rows))
    _assert_same(plain, blocked)


def test_one_user_holds_a_third(spark):
    # user 1 has a third of all visits in one long segment plus a few gaps; the rest are small users
    rows = []
    vid = 0
    codes = ["2_2", "3_1_2", "0", "3_1", "4", "1", "3_12"]
    for i in range(300):
        vid += 1
        t = i * 10 + (5000 if i >= 150 else 0) + (9000 if i >= 260 else 0)
        rows.append((vid, t, codes[(i * 5) % 7], 1 if i % 11 == 0 else 0, float(i % 13), i % 4, 1))
    for u in range(2, 62):
        for j in range(10):
            vid += 1
            rows.append((vid, j * 700 + u, codes[(u + j) % 7], 1 if (u + j) % 5 == 0 else 0, 2.5, 0, u))
    v = visits_df(spark, rows)
    plain = touches(v, 1000.0, hot_user_rows=None)
    blocked = touches(v, 1000.0, hot_user_rows=200, block_rows=16)
    normal, hot = split_hot(v.withColumn("ts", F.unix_timestamp("UTCStartTime")), ["CounterID", "UserID"], 200, 16)
    assert hot.select("UserID").distinct().collect()[0][0] == 1
    assert hot.groupBy("blk").count().agg(F.max("count")).first()[0] <= 32
    _assert_same(_rows(plain), _rows(blocked))
    a = {r["SourceCode"]: r.asDict() for r in positions.source_measures(plain).collect()}
    b = {r["SourceCode"]: r.asDict() for r in positions.source_measures(blocked).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c, val in a[k].items():
            assert b[k][c] == pytest.approx(val), (k, c)


def test_no_hot_users_means_no_blocked_branch(spark):
    v = visits_df(spark, [(1, 0, "1"), (2, 10, "4")])
    plan = touches(v, 100.0, hot_user_rows=10)._jdf.queryExecution().analyzed().toString()
    assert "blk" not in plan


def test_blocked_gaps_same_multiset(visits001):
    from touchline.operators.gaps import visit_gaps
    plain = sorted(r.gap for r in visit_gaps(visits001, hot_user_rows=None).collect())
    blocked = sorted(r.gap for r in visit_gaps(visits001, hot_user_rows=0, block_rows=3).collect())
    assert plain == blocked
    assert gap_quantile(visits001, hot_user_rows=0, block_rows=2) == gap_quantile(visits001, hot_user_rows=None)


def test_blocked_chain_export(spark, visits001):
    from touchline.operators.chains import chains
    d = gap_quantile(visits001)
    t = touches(visits001, d, hot_user_rows=None).cache()

    def key(df):
        return sorted(tuple(r) for r in df.collect())
    assert key(chains(t, d, "2024-01-29", hot_user_rows=0, block_rows=3)) == key(
        chains(t, d, "2024-01-29", hot_user_rows=None))


def test_asof_last_buckets(spark):
    from touchline.operators.asof import asof_last
    pts = spark.createDataFrame([(1, p, p * 10) for p in (3, 7, 8, 20)] + [(2, 5, 50)], "k long, pos long, value long")
    qs = spark.createDataFrame([(1, q) for q in (1, 3, 4, 9, 19, 20, 40)] + [(2, 4), (2, 6)], "k long, pos long")
    got = {(r.k, r.pos): r.value for r in asof_last(pts, qs, ["k"], 2).collect()}
    assert got == {(1, 1): None, (1, 3): 30, (1, 4): 30, (1, 9): 80, (1, 19): 80, (1, 20): 200, (1, 40): 200,
                   (2, 4): None, (2, 6): 50}


def test_many_hot_keys_are_not_broadcast(spark, visits001, monkeypatch):
    from touchline.operators import skew
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 3)
    d = gap_quantile(visits001)
    hot = skew.hot_key_list(visits001.select("CounterID", "UserID", F.unix_timestamp("UTCStartTime").alias("ts")),
                            ["CounterID", "UserID"], 0)
    assert "ResolvedHint" not in hot._jdf.queryExecution().analyzed().toString()
    _assert_same(_rows(touches(visits001, d, hot_user_rows=None)),
                 _rows(touches(visits001, d, hot_user_rows=0, block_rows=5)))


def test_facade_materialised_with_hot_users(spark, raw001):
    from touchline.plans.analytics import ChainAnalytics
    plain = ChainAnalytics(spark, raw001, "2024-01-02", "2024-01-29", hot_user_rows=None)
    hot = ChainAnalytics(spark, raw001, "2024-01-02", "2024-01-29", hot_user_rows=40, block_rows=7)
    hot.combine_visits(materialize=True)
    assert hot.hot_users() is not None
    for report in ("simple_attributions", "associated_conversions", "source_in_chains_metrics"):
        a = {r["SourceCode"]: r.asDict() for r in getattr(plain, report)().collect()}
        b = {r["SourceCode"]: r.asDict() for r in getattr(hot, report)().collect()}
        assert a.keys() == b.keys(), report
        for k in a:
            for c, v in a[k].items():
                if isinstance(v, float):
                    assert b[k][c] == pytest.approx(v, rel=1e-9, abs=1e-12), (report, k, c)
                else:
                    assert b[k][c] == v, (report, k, c)
    assert hot.chains().count() == plain.chains().count()
    plain.release()
    hot.release()


def test_hot_user_lists_user_and_pair_level(spark):
    from touchline.operators.skew import hot_user_lists
    rows = [(1, 7)] * 3 + [(2, 7)] * 3 + [(1, 8)] * 5 + [(1, 9)] * 2
    df = spark.createDataFrame(rows, "CounterID long, UserID long")
    users, pairs = hot_user_lists(df, 4)
    assert sorted(r.UserID for r in users.collect()) == [7, 8]          # 7: 3 + 3 over two counters
    assert sorted((r.CounterID, r.UserID) for r in pairs.collect()) == [(1, 8)]
    assert hot_user_lists(df, 10) == (None, None)


def test_a_crowded_second_with_an_odd_id(spark):
    """One id far from the others does not put all of a second's rows into one block."""
    ids = spark.range(1000).selectExpr("1L AS UserID", "100L AS ts", "IF(id = 7, 4611686018427387904L, id) AS VisitID")
    _, hot = split_hot(ids, ["UserID"], 0, 50)
    sizes = [r["count"] for r in hot.groupBy("blk").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 60
    order = [r.blk for r in hot.orderBy("VisitID").collect()]
    assert order == sorted(order)


def test_hot_chains_read_stored_rows(spark, raw001):
    """Each step of the hot path is computed once: the chain table's plan starts at the stored elements."""
    v = latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1])
    kw = {"hot_user_rows": 0, "block_rows": 7}
    full = chains(touches(v, 86400.0, **kw), 86400.0, "2024-01-29", **kw)
    plan = full._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 12, plan.count("Window [")


def test_chains_need_no_credits(spark, raw001):
    v = latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1])
    for kw in ({}, {"hot_user_rows": 0, "block_rows": 7}):
        full = touches(v, 86400.0, **kw)
        short = touches(v, 86400.0, credits=False, **kw)
        assert short.columns == [c for c in full.columns if c in short.columns] and "suf_n" not in short.columns
        assert sorted(short.collect()) == sorted(full.select(*short.columns).collect())
