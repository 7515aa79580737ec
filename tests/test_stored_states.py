"""Stored layout, bucket-wise chains, hash ranges and mergeable states against the plain forms."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from touchline.functions.inthash import int_hash32, with_int_hash32
from touchline.operators.distinct_state import daily_user_sketches, users_by_source
from touchline.operators.gap_state import daily_gap_state, gap_quantile_of_state, read_gap_state, save_gap_state
from touchline.operators.gaps import gap_quantile
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits, with_source_code
from touchline.plans.incremental_chains import ChainStore
from touchline.sources import user_bucket
from touchline.sources.layout import save_visits_by_user

PERIOD = ("2024-01-02", "2024-01-29")


@pytest.fixture(scope="module")
def live(raw001):
    return latest_live_visits(raw001, *PERIOD, [-1]).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_layout_needs_no_exchange(spark, live, tmpdir_path):
    save_visits_by_user(live, "visits_by_user", 4, f"{tmpdir_path}/by_user")
    stored = spark.table("visits_by_user")
    found = touches(stored, 100_000.0, hot=None)
    assert "Exchange" not in plan(found) and "Exchange" in plan(touches(live, 100_000.0, hot=None))
    assert rows(found) == rows(touches(live, 100_000.0, hot=None))
    assert "Exchange" not in plan(stored.groupBy("CounterID", "UserID").count())
    assert len(glob.glob(f"{tmpdir_path}/by_user/*.parquet")) <= 4
    spark.sql("DROP TABLE visits_by_user")


def test_hot_users_are_written_by_several_tasks(spark, live, tmpdir_path):
    hot = live.withColumn("UserID", F.when(F.col("VisitID") % 3 == 0, 77).otherwise(F.col("UserID")))
    save_visits_by_user(hot, "visits_hot", 4, f"{tmpdir_path}/hot", hot_user_rows=100)
    stored = spark.table("visits_hot")
    files = stored.where("UserID = 77").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert rows(stored.select(*live.columns)) == rows(hot)
    found = touches(stored, 100_000.0, hot=None)
    assert "Exchange" not in plan(found) and rows(found) == rows(touches(hot, 100_000.0, hot=None))
    spark.sql("DROP TABLE visits_hot")


def store_of(spark, path, **kw):
    return ChainStore(spark, path, *PERIOD, [-1], 100_000.0, 6, **kw)


def files(path, bucket):
    return sorted(glob.glob(f"{path}/bucket={bucket}/*.parquet"))


@pytest.mark.parametrize("kw", [{}, {"hot_user_rows": 5, "block_rows": 3}])
def test_refresh_equals_build_and_leaves_other_buckets(spark, raw001, tmpdir_path, kw):
    users = sorted({r.UserIDHash for r in raw001.select("UserIDHash").distinct().collect()})[:3]
    late = F.col("UserIDHash").isin(users) & (F.col("VisitVersion") > 1)
    store = store_of(spark, f"{tmpdir_path}/chains", **kw)
    store.build(raw001.where(~late))
    before = {b: files(store.path, b) for b in range(6)}
    touched = store.refresh(raw001, raw001.where(late))
    assert touched and len(touched) < 6
    whole = store_of(spark, f"{tmpdir_path}/whole", **kw)
    whole.build(raw001)
    assert rows(store.read().select(*whole.read().columns)) == rows(whole.read())
    for b in range(6):
        assert (files(store.path, b) == before[b]) == (b not in touched)


def test_refresh_with_cancelled_users_and_nothing_new(spark, raw001, tmpdir_path):
    one = raw001.where("UserIDHash % 2 = 0")
    store = store_of(spark, f"{tmpdir_path}/chains")
    store.build(one)
    assert store.refresh(one, one.limit(0)) == []
    gone = one.where("VisitVersion = 1 AND Sign = 1").select(
        *[F.lit(-9).cast("int").alias("Sign") if c == "Sign" else
          (F.col(c) + 50).alias(c) if c == "VisitVersion" else F.col(c) for c in one.columns])
    later = one.unionByName(gone)
    store.refresh(later, gone)
    assert not glob.glob(f"{store.path}/bucket=*/*.parquet")


def test_int_hash(spark):
    random.seed(4)
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, 42] + [random.randrange(-2 ** 63, 2 ** 63) for _ in range(200)]
    found = with_int_hash32(spark.createDataFrame([(k,) for k in keys], "k long"), "k", "h").collect()
    assert [r.h for r in found] == [int_hash32(k) for k in keys]
    spread = [int_hash32(k) for k in range(20_000)]
    assert len(set(spread)) > 19_990 and abs(sum(h < 2 ** 31 for h in spread) / 20_000 - 0.5) < 0.02


def test_hash_ranges_cover_users_once(live):
    seen = [{r.UserID for r in user_bucket(live, 5, i, method="range").select("UserID").distinct().collect()}
            for i in range(5)]
    assert sum(map(len, seen)) == len(set().union(*seen)) == live.select("UserID").distinct().count()
    assert all(int_hash32(u) * 5 >> 32 == i for i, own in enumerate(seen) for u in own)


def test_hash_range_filter_stays_small(live):
    """The steps of the hash are not written into each other when the filter on it moves towards the scan."""
    plan = user_bucket(live, 8, 3, method="range")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("^") < 100


@pytest.mark.parametrize("kw", [{}, {"hot_user_rows": 3, "block_rows": 2}])
def test_threshold_from_state(live, kw):
    inside, ends = daily_gap_state(live, **kw)
    inside, ends = inside.cache(), ends.cache()
    for a, b in (PERIOD, ("2024-01-05", "2024-01-05"), ("2024-01-03", "2024-01-15"), ("2030-01-01", "2030-01-02")):
        own = live.where(F.col("StartDate").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
        assert gap_quantile_of_state(inside, ends, a, b) == gap_quantile(own, 0.95)


def test_interleaved_dates_raise(spark, live):
    odd = live.withColumn("StartDate", F.when(F.col("VisitID") % 2 == 0, F.date_add("StartDate", 1))
                          .otherwise(F.col("StartDate"))).withColumn("UserID", F.lit(1).cast("long"))
    inside, ends = daily_gap_state(odd)
    with pytest.raises(Exception, match="interleave"):
        gap_quantile_of_state(inside, ends, *PERIOD)


def test_sketches_of_dates_unite(spark, live):
    visits = with_source_code(live)
    whole = visits.groupBy("SourceCode").agg(F.countDistinct("CounterID", "UserID").alias("users"))
    parts = users_by_source(daily_user_sketches(visits), *PERIOD)
    assert {r.SourceCode: r.users for r in parts.collect()} == {r.SourceCode: r.users for r in whole.collect()}
    many = spark.range(300_000).selectExpr("id AS UserID", "1L AS CounterID", "'0' AS SourceCode",
                                           "date_add(DATE'2024-01-02', cast(id % 7 AS int)) AS StartDate")
    again = many.unionByName(many.withColumn("StartDate", F.date_add("StartDate", 1)))
    (estimate,) = users_by_source(daily_user_sketches(again), *PERIOD).collect()
    assert abs(estimate.users - 300_000) <= 0.02 * 300_000


def test_state_is_replaced_by_date(spark, live, tmpdir_path):
    path = f"{tmpdir_path}/state"
    first = live.where("VisitID % 5 <> 0 OR StartDate <> DATE'2024-01-10'")
    save_gap_state(first, path)
    before = {p: sorted(glob.glob(f"{path}/{p}/StartDate=*/*.parquet")) for p in ("inside", "ends")}
    save_gap_state(live.where("StartDate = DATE'2024-01-10'"), path)
    for part, was in before.items():
        now = sorted(glob.glob(f"{path}/{part}/StartDate=*/*.parquet"))
        assert {f for f in was if "2024-01-10" not in f} == {f for f in now if "2024-01-10" not in f}
    assert gap_quantile_of_state(*read_gap_state(spark, path), *PERIOD) == gap_quantile(live, 0.95)


def test_facade_with_state_and_published_tables(spark, raw001, live, tmpdir_path, capsys):
    from touchline.__main__ import main
    from touchline.plans.analytics import ChainAnalytics
    from touchline.sources import read_published
    save_gap_state(live, f"{tmpdir_path}/state")
    plain = ChainAnalytics(spark, raw001, *PERIOD)
    merged = ChainAnalytics(spark, raw001, *PERIOD, gap_state=read_gap_state(spark, f"{tmpdir_path}/state"))
    assert merged.visit_gap_threshold() == plain.visit_gap_threshold()
    raw001.write.parquet(f"{tmpdir_path}/raw")
    for _ in range(2):
        main(["--raw", f"{tmpdir_path}/raw", "--start", PERIOD[0], "--end", PERIOD[1], "--publish",
              "--gap-state", f"{tmpdir_path}/state", "--visits-out", f"{tmpdir_path}/visits",
              "--chains-out", f"{tmpdir_path}/chains", "--out", f"{tmpdir_path}/reports"])
    assert read_published(spark, f"{tmpdir_path}/visits").count() == live.count()
    found = read_published(spark, f"{tmpdir_path}/chains")
    assert rows(found.select("UserID", "chain", "pos", "VisitID")) == rows(
        plain.chains().select("UserID", "chain", "pos", "VisitID"))
    assert len(glob.glob(f"{tmpdir_path}/visits/v-*")) == 2 and "== conv_chains ==" in capsys.readouterr().out
    plain.release()


def test_recorders_inside_each_other(spark):
    """Lists that hold the same are told apart."""
    from touchline.session import checkpointed, delete_paths, recorded
    outer, inner = [], []
    with recorded(outer):
        with recorded(inner):
            checkpointed(spark.range(1), "one")
        checkpointed(spark.range(1), "two")
    checkpointed(spark.range(1), "three")
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]
    delete_paths(spark, inner + outer)
