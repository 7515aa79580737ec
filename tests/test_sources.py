"""Loaders, sinks and sampling."""

import gzip
import json
import os

from pyspark.sql import functions as F

from touchline.operators.gaps import gap_quantile
from touchline.operators.visits import latest_live_visits
from touchline.sources import (
    append_tsv, load_json_dump, no_source_names, read_source_names, user_bucket, user_sample,
    write_report_tsv, write_visits,
)
from touchline.plans.fixture import fixture_name_rows, fixture_names


def test_events_adapter_rows(raw001):
    assert raw001.count() == 3042
    live = latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1])
    assert live.count() == 887
    assert round(live.agg(F.sum("Revenue")).first()[0], 2) == 9825.33


def test_json_dump_envelope(spark, tmpdir_path):
    doc = {"meta": [], "rows": 2, "data": [
        {"CounterID": 1, "UserIDHash": 5, "VisitID": 9, "VisitVersion": 1, "Sign": 1,
         "StartDate": "2024-01-05", "UTCStartTime": "2024-01-05 10:00:00", "Duration": 12,
         "TrafficSource.Model": [2, 1], "TrafficSource.StartTime": ["2024-01-04 10:00:00", "2024-01-05 13:00:00"],
         "TrafficSource.ID": [1, 2], "TrafficSource.SearchEngineID": [9, 3], "TrafficSource.AdvEngineID": [0, 0],
         "TrafficSource.SocialSourceNetworkID": [0, 0], "TrafficSource.ClickBannerID": [0, 0],
         "TrafficSource.ClickTargetType": [0, 0], "TrafficSource.RecommendationSystemID": [0, 0],
         "TrafficSource.MessengerID": [0, 0], "EPurchase.ID": ["x"], "EPurchase.Revenue": [2500000],
         "Goals.ID": [], "Goals.Price": []},
        {"CounterID": 1, "UserIDHash": 5, "VisitID": 10, "VisitVersion": 1, "Sign": 1,
         "StartDate": "2024-01-06", "UTCStartTime": "2024-01-06 10:00:00", "Duration": 0,
         "TrafficSource.Model": [1], "TrafficSource.StartTime": ["2024-01-06 13:00:00"],
         "TrafficSource.ID": [0], "TrafficSource.SearchEngineID": [0], "TrafficSource.AdvEngineID": [0],
         "TrafficSource.SocialSourceNetworkID": [0], "TrafficSource.ClickBannerID": [0],
         "TrafficSource.ClickTargetType": [0], "TrafficSource.RecommendationSystemID": [0],
         "TrafficSource.MessengerID": [0], "EPurchase.ID": [], "EPurchase.Revenue": [],
         "Goals.ID": [], "Goals.Price": []},
    ]}
    path = os.path.join(tmpdir_path, "dump.json.gz")
    with gzip.open(path, "wt") as f:
        json.dump(doc, f)
    raw = load_json_dump(spark, path, envelope=True)
    v = {r.VisitID: r for r in latest_live_visits(raw, "2024-01-01", "2024-01-31", [-1]).collect()}
    assert (v[9].TraficSourceID, v[9].SearchEngineID, v[9].Revenue) == (2, 3, 2.5)
    assert v[10].Conversions == 0
    lines = os.path.join(tmpdir_path, "dump.jsonl")
    with open(lines, "w") as f:
        for row in doc["data"]:
            f.write(json.dumps(row) + "\n")
    raw2 = load_json_dump(spark, lines, envelope=False)
    assert sorted(r.VisitID for r in raw2.collect()) == [9, 10]


def test_names_tsv_and_report_tsv(spark, tmpdir_path):
    names = fixture_names(spark)
    assert names.count() == len(fixture_name_rows())
    assert dict(names.collect())["-1"] == "Internal"  # codes stay text
    out = os.path.join(tmpdir_path, "report")
    write_report_tsv(names, out)
    back = read_source_names(spark, out)
    assert sorted(back.collect()) == sorted(names.collect())


def test_append_tsv(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "n.tsv")
    with open(path, "w") as f:
        f.write("SourceCode\tSourceName\n0\tDirect\n2_2\tSearch\n")
    append_tsv(spark, path, "names_upload")
    append_tsv(spark, path, "names_upload")
    assert spark.table("names_upload").count() == 4


def test_user_buckets_cover_users_once(raw001):
    v = latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1])
    users = {r.UserID for r in v.select("UserID").distinct().collect()}
    seen = []
    for i in range(4):
        seen += [r.UserID for r in user_bucket(v, 4, i).select("UserID").distinct().collect()]
    assert sorted(seen) == sorted(users)
    s = user_sample(v, 10, method="modulo")
    assert {r.UserID % 10 for r in s.select("UserID").distinct().collect()} <= {0}
    assert gap_quantile(v, 0.95, sample_denominator=10, sample_method="modulo") is not None


def test_write_visits_partitioned(spark, raw001, tmpdir_path):
    v = latest_live_visits(raw001, "2024-01-02", "2024-01-29", [-1])
    out = os.path.join(tmpdir_path, "visits")
    write_visits(v, out)
    back = spark.read.parquet(out)
    assert back.count() == 887
    assert back.where(F.col("StartDate") == "2024-01-05").count() == v.where(F.col("StartDate") == "2024-01-05").count()


def test_unsigned_64bit_ids_from_json(spark, tmpdir_path):
    big = 2 ** 64 - 5  # above the signed range
    rows = [{"CounterID": 1, "UserIDHash": str(big), "VisitID": str(2 ** 63 + 7), "VisitVersion": 1, "Sign": 1,
             "StartDate": "2024-01-05", "UTCStartTime": "2024-01-05 10:00:00", "Duration": 3,
             "TrafficSource.Model": [1], "TrafficSource.StartTime": ["2024-01-05 13:00:00"],
             "TrafficSource.ID": [3], "TrafficSource.SearchEngineID": [0], "TrafficSource.AdvEngineID": [1],
             "TrafficSource.SocialSourceNetworkID": [0], "TrafficSource.ClickBannerID": [str(big)],
             "TrafficSource.ClickTargetType": [2], "TrafficSource.RecommendationSystemID": [0],
             "TrafficSource.MessengerID": [0], "EPurchase.ID": [], "EPurchase.Revenue": [],
             "Goals.ID": [], "Goals.Price": []}]
    path = os.path.join(tmpdir_path, "u64.jsonl")
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    raw = load_json_dump(spark, path, envelope=False)
    r = raw.first()
    assert r.UserIDHash == big - 2 ** 64 and r.VisitID == 2 ** 63 + 7 - 2 ** 64
    v = latest_live_visits(raw, "2024-01-01", "2024-01-31", [-1]).first()
    assert v.ClickBannerID == big - 2 ** 64 and v.TraficSourceID == 3


def test_cluster_conf_sizes():
    from touchline.session import cluster_conf
    c = cluster_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 << 20)
    assert int(cluster_conf(10 << 20, 64)["spark.sql.shuffle.partitions"]) == 192


def test_command_line_job(spark, raw001, tmpdir_path, capsys):
    from touchline.__main__ import main
    raw_dir = os.path.join(tmpdir_path, "raw")
    raw001.write.parquet(raw_dir)
    out = os.path.join(tmpdir_path, "out")
    chains_out, visits_out = os.path.join(tmpdir_path, "chains"), os.path.join(tmpdir_path, "visits")
    main(["--raw", raw_dir, "--start", "2024-01-02", "--end", "2024-01-29", "--goals", "-1", "--out", out,
          "--chains-out", chains_out, "--visits-out", visits_out])
    assert spark.read.parquet(visits_out).count() == 887
    assert spark.read.parquet(chains_out).where("EventType = '2_VISIT'").count() == 887
    back = spark.read.option("sep", "\t").option("header", True).csv(os.path.join(out, "simple_attributions"))
    assert back.count() == 34 and "LinearAttrVisits" in back.columns
    assert "== conv_chains ==" in capsys.readouterr().out


def test_date_filter_prunes_partitions(spark, raw001, tmpdir_path):
    from touchline.sources import read_raw_visits
    path = os.path.join(tmpdir_path, "raw_by_day")
    raw001.write.partitionBy("StartDate").parquet(path)
    raw = read_raw_visits(spark, path)
    v = latest_live_visits(raw, "2024-01-05", "2024-01-06", [-1])
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(StartDate" in plan and "2024-01-05" in plan
    days = {r.StartDate.isoformat() for r in v.select("StartDate").distinct().collect()}
    assert days == {"2024-01-05", "2024-01-06"}
    assert v.count() == latest_live_visits(raw001, "2024-01-05", "2024-01-06", [-1]).count()
