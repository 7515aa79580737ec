"""JSON exports: columns from all rows, documents read by many tasks."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from touchline.operators.visits import latest_live_visits
from touchline.plans.registry_stored import _document_parts
from touchline.sources import load_json_dump


def row(i, **more):
    return {"CounterID": 1, "UserIDHash": "5", "VisitID": str(i), "VisitVersion": 1, "Sign": 1, "StartDate": "2024-01-05",
            "UTCStartTime": "2024-01-05 10:00:00", "Duration": i, "TrafficSource.Model": [1], "TrafficSource.ID": [2],
            "EPurchase.ID": ["x"], "Goals.ID": [], **more}


def live(raw):
    return sorted((r.VisitID, r.Revenue, r.SearchEngineID) for r in latest_live_visits(
        raw, "2024-01-01", "2024-01-31", [-1]).collect())


def pretty(rows, extra=""):
    """A document as exports write it: tabs, one field a line."""
    def value(r):
        return "\t\t{\n" + ",\n".join(f"\t\t\t{json.dumps(k)}: {json.dumps(v)}" for k, v in r.items()) + "\n\t\t}"
    meta = ",\n".join('\t\t{\n\t\t\t"name": "%s",\n\t\t\t"type": "String"\n\t\t}' % k for k in rows[0]) if rows else ""
    return ('{\n\t"meta":\n\t[\n' + meta + '\n\t],\n\n\t"data":\n\t[\n' + ",\n".join(map(value, rows))
            + f'\n\t],\n\n\t"rows": {len(rows)}{extra}\n}}\n')


def save(folder, name, text):
    path = os.path.join(folder, name)
    with (gzip.open if name.endswith("gz") else open)(path, "wt") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("turned", [False, True])
def test_a_column_that_one_row_lacks(spark, tmpdir_path, turned):
    both = [row(1), row(2, **{"EPurchase.Revenue": [5000000], "TrafficSource.SearchEngineID": [3]})]
    path = save(tmpdir_path, "e.jsonl", "\n".join(json.dumps(r) for r in (both[::-1] if turned else both)) + "\n\n")
    assert live(load_json_dump(spark, path)) == [(1, 0.0, 0), (2, 5.0, 3)]


def test_a_column_that_no_row_has(spark, tmpdir_path):
    lacking = [{k: v for k, v in row(i).items() if k != "TrafficSource.Model"} for i in (1, 2)]
    path = save(tmpdir_path, "e.jsonl", "\n".join(map(json.dumps, lacking)))
    with pytest.raises(ValueError, match="TrafficSource.Model"):
        load_json_dump(spark, path)


def many(n=400):
    return [row(i, **{"EPurchase.Revenue": [i * 1000000], "TrafficSource.SearchEngineID": [i % 7],
                      "EPurchase.ID": ['a "quoted" {x} ] "data": [{ ' + "y" * (i % 50)]}) for i in range(1, n + 1)]


def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")


@pytest.fixture
def splits(spark):
    small_splits(spark)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_document_is_read_by_many_tasks(spark, tmpdir_path, splits):
    rows = many()
    want = [(i, float(i), i % 7) for i in range(1, len(rows) + 1)]
    lines = save(tmpdir_path, "e.jsonl", "\n".join(map(json.dumps, rows)))
    for name, text in (("pretty.json", pretty(rows)), ("compact.json", json.dumps({"meta": [{"name": "a", "type": "b"},
                       {"name": "c", "type": "d"}], "data": rows, "rows": len(rows), "statistics": {"elapsed": 1}})),
                       ("bare.json", json.dumps({"data": rows}, separators=(",", ":"))),
                       ("tail.json", pretty(rows, ',\n\n\t"statistics":\n\t{\n\t\t"elapsed": 1\n\t},\n\t"more": {"a": 1}'))):
        raw = load_json_dump(spark, save(tmpdir_path, name, text), envelope=True)
        tasks = raw.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
        assert live(raw) == want and tasks > 1, name
        assert sorted(map(str, raw.collect())) == sorted(map(str, load_json_dump(spark, lines).collect()))


def test_record_ends_inside_texts_and_packed_files(spark, tmpdir_path, splits):
    rows = many(60)
    rows[17]["EPurchase.ID"] = ["cut }, here { and }, {"]
    want = [(i, float(i), i % 7) for i in range(1, 61)]
    for name, text in (("a.json", json.dumps({"data": rows})), ("b.json", pretty(rows)), ("c.json.gz", pretty(rows)),
                       ("d.json.gz", json.dumps({"data": rows}))):
        raw = load_json_dump(spark, save(tmpdir_path, name, text), envelope=True)
        assert live(raw) == want, name
        assert raw.filter(F.exists("EPurchase", lambda p: F.contains(p["ID"], F.lit("here {")))).count() == 1


def test_documents_without_rows_and_several_files(spark, tmpdir_path):
    for name, text in (("empty.json", pretty([])), ("none.json", '{"data":[]}')):
        assert load_json_dump(spark, save(tmpdir_path, name, text), envelope=True).count() == 0
    folder = os.path.join(tmpdir_path, "several")
    os.makedirs(folder)
    for k in range(3):
        save(folder, f"{k}.json", pretty(many(30)[10 * k:10 * k + 10]))
    assert len(live(load_json_dump(spark, folder, envelope=True))) == 30


def test_a_broken_row_raises(spark, tmpdir_path):
    path = save(tmpdir_path, "e.jsonl", json.dumps(row(1)) + '\n{"CounterID": 1, "UserID\n')
    with pytest.raises(Exception):
        load_json_dump(spark, path).collect()


def test_document_in_parts(spark, tmpdir_path, splits):
    """Written by many tasks, the parts are one document, none of them holds it all, and each row is there once."""
    rows = spark.createDataFrame([(i % 399, 1, 1, json.dumps(row(i % 399))) for i in range(400)],
                                 "VisitID long, VisitVersion long, Sign int, value string").repartition(8)
    rows = rows.unionByName(rows.where("VisitID = 398"))        # the last row of the document repeats
    path = os.path.join(tmpdir_path, "parts")
    _document_parts(rows).write.text(path)
    parts = [open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-")]
    whole = json.loads("".join(parts))
    assert whole["rows"] == len(whole["data"]) == 401
    assert sorted(int(r["VisitID"]) for r in whole["data"]) == sorted([i % 399 for i in range(400)] + [398])
    assert max(p.count('"VisitVersion"') for p in parts) < 200
    raw = load_json_dump(spark, path, envelope=True)
    assert sorted(r.VisitID for r in raw.collect()) == sorted([i % 399 for i in range(400)] + [398])
    assert raw.where("StartDate between '2024-01-01' and '2024-01-31'").count() == 401
