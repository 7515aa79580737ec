"""Rebuilds that fail leave the former rows; TSV fields survive the round trip."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from touchline.operators.visits import latest_live_visits
from touchline.sources import (
    append_tsv, publish, publish_table, publish_visits, read_published, read_source_names, read_tsv, save_visits,
    write_tsv, write_visits,
)
from touchline.sources.publish import current_version, versions
from touchline.schema import SOURCE_NAMES


def live(raw001, goals=(-1,)):
    return latest_live_visits(raw001, "2024-01-02", "2024-01-29", list(goals))


def failing(visits):
    """The same rows, but one value that is no sort key raises in its task."""
    return visits.withColumn("Revenue", F.when(F.col("VisitID") % 97 == 5, F.raise_error(F.lit("broken row"))
                                               .cast("double")).otherwise(F.col("Revenue")))


def rows(df):
    return sorted(map(tuple, df.select("VisitID", "StartDate", "Conversions", "Revenue").collect()))


@pytest.mark.parametrize("write, read", [
    (publish_visits, read_published),
    (write_visits, lambda spark, path: spark.read.parquet(path))])
def test_failed_rebuild_keeps_the_former_rows(spark, raw001, tmpdir_path, write, read):
    path = f"{tmpdir_path}/visits"
    write(live(raw001, []), path)
    before = rows(read(spark, path))
    with pytest.raises(Exception, match="broken row"):
        write(failing(live(raw001)), path)
    assert rows(read(spark, path)) == before
    write(live(raw001), path)
    assert rows(read(spark, path)) == rows(live(raw001)) != before
    assert not [p for p in os.listdir(tmpdir_path) if ".former" in p or ".rebuild" in p]


def test_readers_in_progress_keep_their_version(spark, raw001, tmpdir_path):
    path = f"{tmpdir_path}/visits"
    first = publish_visits(live(raw001, []), path)
    reader = read_published(spark, path)
    second = publish_visits(live(raw001), path)
    assert current_version(spark, path) == second and versions(spark, path) == [first, second]
    assert rows(reader) == rows(live(raw001, []))
    # a rebuild may read what it replaces
    third = publish(read_published(spark, path).filter("StartDate < '2024-01-10'"), path)
    assert versions(spark, path) == [second, third]
    assert rows(read_published(spark, path)) == rows(live(raw001).filter("StartDate < '2024-01-10'"))
    with pytest.raises(FileNotFoundError):
        read_published(spark, f"{tmpdir_path}/nothing")


def test_published_name(spark, raw001, tmpdir_path):
    path = f"{tmpdir_path}/versions"
    save_visits(live(raw001, []), "visits_by_name", path=path)
    with pytest.raises(Exception, match="broken row"):
        save_visits(failing(live(raw001)), "visits_by_name", path=path)
    assert rows(spark.table("visits_by_name")) == rows(live(raw001, []))
    save_visits(live(raw001), "visits_by_name", path=path)
    assert rows(spark.table("visits_by_name")) == rows(live(raw001))
    plan = spark.table("visits_by_name").filter("StartDate = '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(StartDate" in plan
    spark.range(3).write.saveAsTable("plain_table")
    with pytest.raises(ValueError, match="is a table"):
        publish_table(spark.range(4), "plain_table", f"{tmpdir_path}/other", [])
    assert spark.table("plain_table").count() == 3


AWKWARD = [None, "", "plain", 'He said "x"', '"Ads', "b\tc", "two\nlines", "car\rriage", "back\\slash", "\\N", "\\\\N",
           "\\t", "ends with \\", " spaces ", "\\\\t\\n", "\0zero", "'single'", "é日本😀", "#comment", "\b\f", "a\\\tb", "\\"]


def test_tsv_round_trip(spark, tmpdir_path):
    schema = "k int, a string, `b\tname` string"
    data = [(i, v, AWKWARD[-1 - i]) for i, v in enumerate(AWKWARD)]
    frame = spark.createDataFrame(data, schema)
    write_tsv(frame.repartition(3), f"{tmpdir_path}/t")
    back = read_tsv(spark, f"{tmpdir_path}/t", frame.schema)
    assert sorted(back.collect(), key=lambda r: r.k) == frame.collect()
    as_text = read_tsv(spark, f"{tmpdir_path}/t")
    assert as_text.columns == ["k", "a", "b\tname"] and as_text.filter("a IS NULL").count() == 1
    write_tsv(frame, f"{tmpdir_path}/plain", header=False)
    assert sorted(read_tsv(spark, f"{tmpdir_path}/plain", frame.schema, header=False).collect(), key=lambda r: r.k) == \
        frame.collect()


def test_tsv_bytes(spark, tmpdir_path):
    frame = spark.createDataFrame([("a\tb", 1.5, True, [1, 2]), (None, None, False, None)],
                                  "t string, x double, f boolean, l array<int>")
    write_tsv(frame, f"{tmpdir_path}/t", one_file=True)
    (part,) = glob.glob(f"{tmpdir_path}/t/part-*")
    assert open(part, "rb").read() == b"t\tx\tf\tl\na\\tb\t1.5\t1\t[1,2]\n\\N\t\\N\t0\t\\N\n"
    back = read_tsv(spark, f"{tmpdir_path}/t", frame.schema.__class__([f for f in frame.schema if f.name != "f"]))
    assert [tuple(r) for r in back.collect()] == [("a\tb", 1.5, [1, 2]), (None, None, None)]


def test_names_with_quotes_and_escapes(spark, tmpdir_path):
    path = f"{tmpdir_path}/n.tsv"
    with open(path, "w", newline="") as f:
        f.write('SourceName\tSourceCode\n"Ads\t2_2\nb\\tc\t0\n\\N\t3\nit\\\'s\t4\n')
    want = [("0", "b\tc"), ("2_2", '"Ads'), ("3", None), ("4", "it's")]
    assert sorted(map(tuple, read_source_names(spark, path).collect())) == want
    append_tsv(spark, path, "names_with_escapes", SOURCE_NAMES)
    append_tsv(spark, path, "names_with_escapes", SOURCE_NAMES)
    assert sorted(map(tuple, spark.table("names_with_escapes").distinct().collect())) == want
    assert spark.table("names_with_escapes").count() == 8


def test_empty_tsv(spark, tmpdir_path):
    write_tsv(spark.createDataFrame([], SOURCE_NAMES), f"{tmpdir_path}/e", one_file=True)
    assert read_tsv(spark, f"{tmpdir_path}/e", SOURCE_NAMES).collect() == []
