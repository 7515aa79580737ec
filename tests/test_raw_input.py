"""Raw visits as real writers leave them: missing sub-columns, reordered structs, NULL groups, instants."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from touchline.operators import positions, reports
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits
from touchline.plans.registry import flat_raw_visits
from touchline.sources import load_json_dump, normalize_raw_visits

PERIOD = ("2024-01-02", "2024-01-29")


def rows(df):
    return sorted(map(tuple, df.collect()))


def live(raw, goals=(-1,)):
    return latest_live_visits(raw, *PERIOD, goals)


def test_missing_subcolumns_take_defaults(raw001):
    found = live(normalize_raw_visits(flat_raw_visits(raw001)))
    assert rows(found.drop("MessengerID")) == rows(live(raw001).drop("MessengerID"))
    assert {r.MessengerID for r in found.select("MessengerID").distinct().collect()} == {0}
    goals = normalize_raw_visits(flat_raw_visits(raw001))
    assert rows(live(goals, [10, 20]).select("VisitID", "Conversions")) == \
        rows(live(raw001, [10, 20]).select("VisitID", "Conversions"))


@pytest.mark.parametrize("column", ["TrafficSource.Model", "TrafficSource.ID", "EPurchase.ID", "Goals.ID", "Duration"])
def test_missing_key_columns_raise(raw001, column):
    with pytest.raises(ValueError, match=column):
        normalize_raw_visits(flat_raw_visits(raw001).drop(F.col(f"`{column}`")))


def test_nested_fields_are_matched_by_name(raw001):
    def turned(group):
        names = raw001.schema[group].dataType.elementType.names
        return F.transform(group, lambda x: F.struct(*[x[n].alias(n) for n in reversed(names)]))

    turned_raw = raw001.withColumns({g: turned(g) for g in ("TrafficSource", "EPurchase", "Goals")})
    assert rows(live(normalize_raw_visits(turned_raw))) == rows(live(raw001))
    no_model = raw001.withColumn("TrafficSource", F.transform("TrafficSource", lambda x: F.struct(x["ID"].alias("ID"))))
    with pytest.raises(ValueError, match="TrafficSource.Model"):
        normalize_raw_visits(no_model)


def test_instants_do_not_follow_the_session_zone(spark, raw001):
    instants = raw001.withColumn("UTCStartTime", F.timestamp_micros(F.unix_timestamp("UTCStartTime") * 1_000_000))
    assert dict(instants.dtypes)["UTCStartTime"] == "timestamp"
    want = rows(live(raw001))
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert rows(live(normalize_raw_visits(instants))) == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("goals", [[-1], [10, 20]])
def test_null_groups_are_empty(raw001, goals):
    nulls = raw001.withColumns({g: F.when(F.size(g) > 0, F.col(g)) for g in ("EPurchase", "Goals", "TrafficSource")})
    assert rows(live(nulls, goals)) == rows(live(raw001, goals))
    assert rows(live(normalize_raw_visits(nulls), goals)) == rows(live(raw001, goals))


def test_a_null_amount_voids_no_credit(spark):
    from tests.helpers import visits_df
    visits = visits_df(spark, [(1, 0, "2_2", 0, 0.0), (2, 50, "0", 1, 10.0)])
    first = F.col("VisitID") == 1
    visits = visits.withColumns({"Revenue": F.when(~first, F.col("Revenue")), "Conversions": F.when(~first, F.col("Conversions"))})
    m = positions.source_measures(touches(visits, 100.0))
    found = {r.SourceCode: r for r in reports.simple_attributions(m).collect()}
    assert found["2_2"].LinearAttrRevenue == 5.0
    credit = {r.SourceCode: r.AssociatedRevenue for r in reports.associated_conversions(m).collect()}
    assert credit == {"2_2": 10.0, "0": 10.0}


def test_json_lines_without_optional_columns(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "rows.jsonl")
    row = {"CounterID": 1, "UserID": "5", "VisitID": "9", "VisitVersion": 1, "Sign": 1, "StartDate": "2024-01-05",
           "UTCStartTime": "2024-01-05 10:00:00", "Duration": 12, "TrafficSource.Model": [1], "TrafficSource.ID": [2],
           "TrafficSource.SearchEngineID": [3], "EPurchase.ID": ["x"], "EPurchase.Revenue": [2500000], "Goals.ID": []}
    with open(path, "w") as f:
        f.write(json.dumps(row) + "\n")
    v = live(load_json_dump(spark, path)).first()
    assert (v.UserID, v.TraficSourceID, v.SearchEngineID, v.MessengerID, v.Revenue) == (5, 2, 3, 0, 2.5)
    assert v.StartTime == dt.datetime(1970, 1, 1)
