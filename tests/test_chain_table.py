"""The chain table: keys, plan, thresholds below a second, sinks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import visits_df
from touchline import ChainAnalytics
from touchline.functions.formats import percent_text
from touchline.operators.chains import chain_elements, chains, churn_markers
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits
from touchline.plans.registry import END, GOALS, START, repeated_ids
from touchline.sources.sinks import write_chains

KEY = ["CounterID", "UserID", "chain", "pos"]


def table(df):
    """Rows with doubles rounded: sums of fractions differ in the last bits by the order of adding."""
    cols = [F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in sorted(df.dtypes)]
    return sorted(map(tuple, df.select(cols).collect()), key=str)


def test_repeated_ids_keep_their_rows(raw001):
    visits = latest_live_visits(repeated_ids(raw001), START, END, GOALS)
    t = touches(visits, 200_000.0, hot_user_rows=None)
    plain = chains(t, 200_000.0, END, hot_user_rows=None)
    assert plain.where("EventType = '2_VISIT'").count() == visits.count() == 887
    blocked = chains(touches(visits, 200_000.0, hot_user_rows=0, block_rows=3), 200_000.0, END, hot_user_rows=0, block_rows=3)
    assert table(plain) == table(blocked)


def test_one_id_on_two_dates_of_one_user(spark):
    v = visits_df(spark, [(1, 0, "2_2"), (2, 50, "0"), (1, 86400, "0")])
    assert chains(touches(v, 200_000.0), 200_000.0, "2030-01-01").where("EventType = '2_VISIT'").count() == 3


def test_at_most_two_exchanges_over_a_stored_touch_table(spark, raw001, tmpdir_path):
    visits = latest_live_visits(raw001, START, END, GOALS)
    touches(visits, 100_000.0, hot_user_rows=None).write.parquet(f"{tmpdir_path}/touches")
    t = spark.read.parquet(f"{tmpdir_path}/touches")
    for df in (chains(t, 100_000.0, END, hot_user_rows=None), churn_markers(t, 100_000.0, END, hot_user_rows=None)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan, plan


def test_all_visits_in_one_second(spark):
    """One hot user whose visits all have the same time: blocks are cut by visit id, results stay the same."""
    v = visits_df(spark, [(i, 0, ["2_2", "0", "3_1_2"][i % 3], i % 2, float(i)) for i in range(1, 60)])
    plain = touches(v, 10.0, hot_user_rows=None)
    blocked = touches(v, 10.0, hot_user_rows=5, block_rows=4)
    assert table(plain) == table(blocked)
    from touchline.operators.skew import split_hot
    _, hot = split_hot(v.withColumn("ts", F.unix_timestamp("UTCStartTime")), ["CounterID", "UserID"], 5, 4)
    sizes = [r["count"] for r in hot.groupBy("blk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 8


def test_threshold_below_one_second_reports(spark):
    v = visits_df(spark, [(1, 0, "2_2", 0, 0.0), (2, 0, "0", 1, 10.0), (3, 0, "1", 0, 0.0)])
    raw_free = ChainAnalytics(spark, None, "2024-01-01", "2024-02-01")
    raw_free._visits = v
    assert raw_free.visit_gap_threshold() == 0.0
    assert raw_free.simple_attributions().count() == 3
    assert raw_free.chains().where("EventType = '2_VISIT'").count() == 3


def test_bad_threshold_argument_raises(spark):
    with pytest.raises(ValueError):
        ChainAnalytics(spark, None, "2024-01-01", "2024-02-01", max_gap=-1)


def test_chain_sink_writes_few_files(spark, raw001, tmpdir_path):
    visits = latest_live_visits(raw001, START, END, GOALS)
    c = chains(touches(visits, 100_000.0), 100_000.0, END)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_chains(c, f"{tmpdir_path}/chains")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    days = glob.glob(f"{tmpdir_path}/chains/StartDate=*")
    files = glob.glob(f"{tmpdir_path}/chains/StartDate=*/*.parquet")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= len(days) + partitions
    assert spark.read.parquet(f"{tmpdir_path}/chains").count() == c.count()


def test_release_deletes_what_was_stored(spark, raw001):
    ca = ChainAnalytics(spark, raw001, START, END)
    ca.combine_visits(materialize=True)
    paths = [p.replace("file:", "") for p in ca._stored]
    assert len(paths) >= 2 and all(os.path.isdir(p) for p in paths)
    ca.release()
    assert not any(os.path.exists(p) for p in paths)


def test_percent_text_is_pythons(spark):
    shares = sorted({k / n for n in range(1, 130) for k in range(n + 1)} | {0.00025, 0.00125, 0.5, 0.0})
    df = spark.createDataFrame([(x,) for x in shares], "x double").coalesce(1)
    found = df.select("x", percent_text("x").alias("two"), percent_text("x", 1).alias("one"),
                      percent_text("x", 0).alias("none")).collect()
    wrong = [(r.x, r.two, f"{r.x:.2%}") for r in found if (r.two, r.one, r.none) != (f"{r.x:.2%}", f"{r.x:.1%}", f"{r.x:.0%}")]
    assert not wrong, wrong[:5]


def test_converting_chains_view(spark, raw001):
    ca = ChainAnalytics(spark, raw001, START, END)
    shown = ca.top_report("conv_chains", 5).collect()
    want = ca.source_in_chains_metrics().orderBy(F.desc("unique_conv_chains_perc"), "SourceCode").limit(5).collect()
    for got, row in zip(shown, want):
        for c in ("in_conv_chains_perc_total", "unique_conv_chains_perc", "last_touch_conv_2plus"):
            assert got[c] == f"{row[c]:.2%}"


def test_markers_without_threshold(spark):
    t = touches(visits_df(spark, [(1, 0, "2_2"), (2, 9, "0")]), None)
    assert churn_markers(t, None, "2030-01-01").count() == 0
    assert chain_elements(t, None, "2030-01-01").count() == 2
