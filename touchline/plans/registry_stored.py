"""Registered queries of loaders, sinks and stored states: each writes what it reads back.

What a query stores lies in a folder of its own under ``spark.checkpoint.dir``; folders of versions that the
result does not read any more are deleted, and so are names in the catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.distinct_state import daily_user_sketches, users_by_source
from touchline.operators.gap_state import daily_gap_state, gap_quantile_of_state
from touchline.operators.gaps import gap_quantile
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits, with_source_code
from touchline.plans import registry as base
from touchline.plans.incremental_chains import ChainStore
from touchline.session import checkpointed, delete_paths, ensure_checkpoint_dir
from touchline.sources.layout import save_visits_by_user
from touchline.sources.publish import read_published
from touchline.sources.raw_visits import load_json_dump
from touchline.sources.sampling import user_bucket
from touchline.sources.sinks import publish_chains, publish_visits, write_visits
from touchline.sources.tsv import read_tsv, write_tsv

#: Periods of the threshold from the stored state.
PERIODS = [(base.START, base.END), ("2024-01-02", "2024-01-12"), ("2024-01-10", "2024-01-29")]
BUCKETS = 8


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/touchline/{name}-{uuid.uuid4().hex}"


def _live(spark: SparkSession, sf_dir: str, goals) -> DataFrame:
    return latest_live_visits(base.raw(spark, sf_dir), base.START, base.END, goals)


def q_visits_published(spark, sf_dir):
    """The visits of another goal are published first, then these in their place."""
    path = _folder(spark, "published")
    publish_visits(_live(spark, sf_dir, []), path)
    publish_visits(_live(spark, sf_dir, base.GOALS), path, keep=0)
    return base._visits_out(read_published(spark, path))


def q_visits_replaced(spark, sf_dir):
    """The same as a plain folder."""
    path = _folder(spark, "replaced")
    write_visits(_live(spark, sf_dir, []), path)
    write_visits(_live(spark, sf_dir, base.GOALS), path)
    return base._visits_out(spark.read.parquet(path))


def q_chains_published(spark, sf_dir):
    path = _folder(spark, "published")
    ca = base.analytics(spark, sf_dir)
    publish_chains(ca.chains(), path)
    ca.release()
    return base._chains_out(read_published(spark, path))


def _exported(spark, sf_dir) -> DataFrame:
    """The raw rows as texts of an export: groups as parallel arrays, empty ones left out of their row."""
    flat = base.flat_raw_visits(base.raw(spark, sf_dir)).withColumn(
        "UTCStartTime", F.date_format("UTCStartTime", "yyyy-MM-dd HH:mm:ss"))
    times = F.transform(F.col("`TrafficSource.StartTime`"), lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
    flat = flat.withColumn("TrafficSource.StartTime", times)
    return flat.select("VisitID", "VisitVersion", "Sign", F.to_json(F.struct(*[F.col(f"`{c}`") for c in flat.columns]))
                       .alias("value"))


def q_visits_json_lines(spark, sf_dir):
    path = _folder(spark, "export")
    _exported(spark, sf_dir).select("value").write.text(path)
    return base._visits_out(latest_live_visits(load_json_dump(spark, path), base.START, base.END, base.GOALS))


def _document_parts(rows: DataFrame) -> DataFrame:
    """The lines of one document, as exports write it: a list of columns, the rows (``_exported``), their number.

    Its head, its records and its end are partitions one after another: written, the parts make the document
    in the order of their names, and no task holds more than its own part of the rows.
    """
    key = F.struct("VisitID", "VisitVersion", "Sign")
    last = rows.agg(F.max(key).alias("k"), F.count(F.lit(1)).alias("n")).first()
    is_last = F.lit(True)
    for name, value in zip(("VisitID", "VisitVersion", "Sign"), last["k"] or (None,) * 3):
        is_last = is_last & F.col(name).eqNullSafe(F.lit(value))
    inner = F.expr("substring(value, 2, length(value) - 2)")

    def record(end: str | Column) -> Column:
        return F.concat(F.lit("\t\t{\n\t\t\t"), inner, F.lit(end) if isinstance(end, str) else end).alias("value")

    spark = rows.sparkSession
    head = '{\n\t"meta":\n\t[\n\t\t{\n\t\t\t"name": "CounterID",\n\t\t\t"type": "UInt32"\n\t\t}\n\t],\n\n\t"data":\n\t['
    start = spark.createDataFrame([(head,)], "value string").coalesce(1)
    # the rows of the greatest key (a few, where a row repeats) and the end of the list
    place = F.row_number().over(Window.partitionBy("VisitID", "VisitVersion", "Sign").orderBy("value"))
    after = F.count(F.lit(1)).over(Window.partitionBy("VisitID", "VisitVersion", "Sign"))
    final = rows.where(is_last).select("value", place.alias("place"), after.alias("n"))
    final = final.select("place", record(F.when(F.col("place") == F.col("n"), "\n\t\t}").otherwise("\n\t\t},")))
    tail = spark.createDataFrame([(None, f'\t],\n\n\t"rows": {last["n"]}\n}}')], "place int, value string")
    final = final.unionByName(tail).repartition(1).sortWithinPartitions(F.col("place").asc_nulls_last()).select("value")
    return start.unionByName(rows.where(~is_last).select(record("\n\t\t},"))).unionByName(final)


def q_visits_json_document(spark, sf_dir):
    """One document, stored in parts in the order of their names."""
    path = _folder(spark, "export")
    _document_parts(_exported(spark, sf_dir)).write.text(path)
    return base._visits_out(latest_live_visits(load_json_dump(spark, path, envelope=True), base.START, base.END, base.GOALS))


def q_labels_tsv(spark, sf_dir):
    """Texts with every character that needs an escape, and NULLs, written and read back."""
    path = _folder(spark, "tsv")
    event = F.col("event_type")
    text = (F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 7 == 1, F.concat(F.lit('"'), event, F.lit("\tsaid \"x\"\n")))
            .when(F.col("event_id") % 7 == 2, F.concat(event, F.lit("\\t\\N\\\\")))
            .when(F.col("event_id") % 7 == 3, F.lit("\\N"))
            .when(F.col("event_id") % 7 == 4, F.lit(""))
            .otherwise(F.concat(F.lit("  "), event, F.lit(" 'é'\r"))))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.alias("label"))
    write_tsv(rows, path)
    return read_tsv(spark, path, rows.schema)


def q_touches_stored_layout(spark, sf_dir):
    """Touches of visits that are stored in buckets of users."""
    name, path = f"visits_by_user_{uuid.uuid4().hex}", _folder(spark, "by-user")
    visits = _live(spark, sf_dir, base.GOALS)
    save_visits_by_user(visits, name, BUCKETS, path)
    try:
        stored = spark.table(name)
        found = checkpointed(base._segments_out(touches(stored, gap_quantile(stored, 0.95))), "by-user-touches")
    finally:
        spark.sql(f"DROP TABLE {name}")
        delete_paths(spark, [path])
    return found


def q_chains_refreshed(spark, sf_dir):
    """The chain table of the first versions of visits, then brought up to date with all later rows."""
    raw = base.raw(spark, sf_dir)
    d = gap_quantile(_live(spark, sf_dir, base.GOALS), 0.95)
    store = ChainStore(spark, _folder(spark, "chain-store"), base.START, base.END, base.GOALS, d, BUCKETS)
    early = (F.col("VisitVersion") == 1) & (F.col("Sign") == 1)
    store.build(raw.where(early))
    store.refresh(raw, raw.where(~early))
    return base._chains_out(store.read())


def q_gap_quantile_hash_range(spark, sf_dir):
    """The threshold of the users in the first half of the hash range."""
    return base._threshold_row(spark, gap_quantile(_live(spark, sf_dir, base.GOALS), 0.95, sample_denominator=2,
                                                   sample_method="range"))


def q_user_buckets(spark, sf_dir):
    """Visits and users in each of the eight buckets that cover every user once."""
    users = _live(spark, sf_dir, base.GOALS).groupBy("UserID").agg(F.count(F.lit(1)).alias("n"))
    users = checkpointed(users, "bucket-users")     # a row a user: the visits are counted once, not once a bucket
    parts = [user_bucket(users, BUCKETS, i, method="range").groupBy(F.lit(i).cast("long").alias("bucket")).agg(
        F.sum("n").alias("visits"), F.count("UserID").alias("users")) for i in range(BUCKETS)]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def q_gap_quantile_of_state(spark, sf_dir):
    """The threshold of three periods from one stored state."""
    visits = checkpointed(_live(spark, sf_dir, base.GOALS), "state-visits")
    inside, ends = (checkpointed(x, "gap-state") for x in daily_gap_state(visits))
    found = [(a, b, gap_quantile_of_state(inside, ends, a, b)) for a, b in PERIODS]
    return spark.createDataFrame([(a, b, None if d is None else round(d, 6)) for a, b, d in found],
                                 "start_date string, end_date string, max_gap double")


def q_source_users_sketched(spark, sf_dir):
    """Exact users of each source, and whether the united daily sketches are within 2 % of them."""
    visits = with_source_code(_live(spark, sf_dir, base.GOALS))
    sketched = users_by_source(checkpointed(daily_user_sketches(visits), "user-sketches"), base.START, base.END)
    exact = visits.groupBy("SourceCode").agg(F.countDistinct("CounterID", "UserID").alias("users"))
    both = exact.join(sketched.withColumnRenamed("users", "estimate"), "SourceCode", "left")
    return both.select("SourceCode", "users", (F.abs(F.col("estimate") - F.col("users")) <= 0.02 * F.col("users"))
                       .alias("close"))


QUERIES = {name: base._wide_ints(fn) for name, fn in {
    "visits_published": q_visits_published,
    "visits_replaced": q_visits_replaced,
    "chains_published": q_chains_published,
    "visits_json_lines": q_visits_json_lines,
    "visits_json_document": q_visits_json_document,
    "labels_tsv": q_labels_tsv,
    "touches_stored_layout": q_touches_stored_layout,
    "chains_refreshed": q_chains_refreshed,
    "gap_quantile_hash_range": q_gap_quantile_hash_range,
    "user_buckets": q_user_buckets,
    "gap_quantile_of_state": q_gap_quantile_of_state,
    "source_users_sketched": q_source_users_sketched,
}.items()}
