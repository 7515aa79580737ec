"""Sinks: each rebuild is one job whose rows take the former ones' place only when it has succeeded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.publish import publish, publish_table, replace_folder
from touchline.sources.tsv import read_tsv, write_tsv

VISIT_LAYOUT = ["StartDate", "CounterID", "UserID", "UTCStartTime"]
CHAIN_LAYOUT = ["StartDate", "CounterID", "UserID", "chain", "pos"]


def _laid_out(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in range partitions of ``keys``: a partition meets few dates, so a table gets about one file
    a partition and one more a date, not one a partition and date; files hold contiguous runs of users,
    and a user with a huge day is split at sampled boundaries instead of landing in one task."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_visits(visits: DataFrame, path: str, mode: str = "overwrite", only_dates: bool = False) -> None:
    """Cleaned visits as a Parquet folder partitioned by StartDate (date filters prune partitions).

    The folder is written beside the old one and put in its place (``publish_visits`` does it in one step).
    ``only_dates``: replace only the StartDate partitions present in ``visits``.
    """
    rows = _laid_out(visits, VISIT_LAYOUT)
    if only_dates:
        rows.write.mode(mode).partitionBy("StartDate").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "overwrite":
        replace_folder(rows, path)
    else:
        rows.write.mode(mode).partitionBy("StartDate").parquet(path)


def write_visits_dates(visits: DataFrame, path: str) -> None:
    """Replace only the StartDate partitions present in ``visits`` (incremental rebuild)."""
    write_visits(visits, path, only_dates=True)


def write_chains(chains: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Chain table, partitioned by StartDate, laid out and replaced like the visits."""
    rows = _laid_out(chains, CHAIN_LAYOUT)
    if mode == "overwrite":
        replace_folder(rows, path)
    else:
        rows.write.mode(mode).partitionBy("StartDate").parquet(path)


def publish_visits(visits: DataFrame, path: str, keep: int = 1) -> str:
    """Cleaned visits as the new version of ``path``, for ``read_published``."""
    return publish(_laid_out(visits, VISIT_LAYOUT), path, keep=keep)


def publish_chains(chains: DataFrame, path: str, keep: int = 1) -> str:
    """The chain table as the new version of ``path``, for ``read_published``."""
    return publish(_laid_out(chains, CHAIN_LAYOUT), path, keep=keep)


def _save(rows: DataFrame, table: str, path: str | None, mode: str) -> None:
    if mode != "overwrite":
        rows.write.mode(mode).partitionBy("StartDate").format("parquet").saveAsTable(table)
        return
    spark = rows.sparkSession
    home = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
    publish_table(rows, table, home)


def save_visits(visits: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> None:
    """Cleaned visits under a catalog name: with ``overwrite`` a view that is switched to the new rows in one
    step (their folders are under ``path``, by default in the warehouse), else rows of a plain table."""
    _save(_laid_out(visits, VISIT_LAYOUT), table, path, mode)


def save_chains(chains: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> None:
    """The chain table under a catalog name, like the visits."""
    _save(_laid_out(chains, CHAIN_LAYOUT), table, path, mode)


def write_report_tsv(report: DataFrame, path: str, header: bool = True) -> None:
    """A report as tab-separated text with escapes and a header line (one file; reports are small)."""
    write_tsv(report, path, header, one_file=True)


def append_tsv(spark, tsv_path: str, table: str, schema=None) -> DataFrame:
    """Append a tab-separated file with escapes and a header to a catalog table; returns the rows read."""
    rows = read_tsv(spark, tsv_path, schema)
    if spark.catalog.tableExists(table):
        target = spark.table(table).schema
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in target.fields])
    rows.write.mode("append").saveAsTable(table)
    return rows
