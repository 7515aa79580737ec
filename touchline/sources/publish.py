"""Rebuilt tables that readers switch to in one step.

A rebuild goes to a folder of its own, ``<path>/v-<number>-<id>``. Only when its job has committed is the
pointer moved: the file ``<path>/_current`` for a path, the view for a catalog name. A rebuild that fails
anywhere leaves the former rows as they were; readers that began on them go on, for ``keep`` former versions stay.

The pointer of a path is written beside the old one and renamed over it, which file systems with atomic
rename (HDFS, local) make one step; object stores replace the small file in one step anyway. A catalog
name is a view over the current folder, replaced by one metastore call, so a name that was published can be
read by every session of the catalog.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from touchline.session import delete_paths

POINTER = "_current"
_VERSION = re.compile(r"v-(\d{13,})-[0-9a-f]{32}$")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) in the JVM, wherever the path is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step."""
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    beside = f"{path}.{uuid.uuid4().hex}"
    fs, new = _hadoop(spark, beside)
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    qualified = fs.makeQualified(new)
    context.rename(qualified, fs.makeQualified(_hadoop(spark, path)[1]), options)


def _get(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of all versions under ``path``, oldest first; such as failed are among them."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    found = sorted((m for m in map(_VERSION.match, names) if m), key=lambda m: (int(m.group(1)), m.string))
    return [f"{path.rstrip('/')}/{m.string}" for m in found]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that readers of ``path`` see, or None where nothing was published."""
    text = _get(spark, f"{path.rstrip('/')}/{POINTER}")
    return None if text is None else f"{path.rstrip('/')}/{json.loads(text)['version']}"


def _write_version(rows: DataFrame, path: str, partition_by: list[str]) -> str:
    folder = f"{path.rstrip('/')}/v-{time.time_ns() // 1_000_000}-{uuid.uuid4().hex}"
    writer = rows.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return folder


def _delete_old(spark: SparkSession, path: str, now: str, keep: int) -> None:
    """All versions older than the current one but the last ``keep``. Newer ones are another's rebuild."""
    before = [v for v in versions(spark, path) if v.rsplit("/", 1)[1] < now.rsplit("/", 1)[1]]
    delete_paths(spark, before[:max(0, len(before) - keep)])


def publish(rows: DataFrame, path: str, partition_by: list[str] | tuple = ("StartDate",), keep: int = 1) -> str:
    """Write ``rows`` as the new version of ``path`` and move its pointer; returns the version's folder.

    ``rows`` may read the current version. ``keep``: former versions that stay for readers in progress.
    """
    spark = rows.sparkSession
    folder = _write_version(rows, path, list(partition_by))
    _put(spark, f"{path.rstrip('/')}/{POINTER}", json.dumps({"version": folder.rsplit("/", 1)[1]}))
    _delete_old(spark, path, folder, keep)
    return folder


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the current version; what is published later does not change this frame."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    return spark.read.parquet(folder)


def _quoted(name: str) -> str:
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def publish_table(rows: DataFrame, name: str, path: str, partition_by: list[str] | tuple = ("StartDate",),
                  keep: int = 1) -> str:
    """The same for a catalog name: a view over the current version, replaced in one step.

    A table of that name that was not published this way raises, it is never dropped here.
    """
    spark = rows.sparkSession
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table; publish under another name, or drop it first")
    folder = _write_version(rows, path, list(partition_by))
    fs, p = _hadoop(spark, folder)
    place = str(fs.makeQualified(p).toString()).replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT * FROM parquet.`{place}`")
    _delete_old(spark, path, folder, keep)
    return folder


def replace_folder(rows: DataFrame, path: str, partition_by: list[str] | tuple = ("StartDate",)) -> None:
    """A plain Parquet folder rebuilt without the loss of its rows: written beside it, then put in its place.

    The old folder moves away and the new one in by two renames; a reader between them finds no folder (use
    ``publish`` where that matters). If the second rename fails, the first is taken back.
    """
    spark = rows.sparkSession
    path = path.rstrip("/")
    new = _write_version(rows, f"{path}.rebuild", list(partition_by))
    fs, target = _hadoop(spark, path)
    staged = _hadoop(spark, new)[1]
    try:
        if fs.exists(target):
            old = _hadoop(spark, f"{path}.former-{uuid.uuid4().hex}")[1]
            if not fs.rename(target, old):
                raise OSError(f"{path} could not be moved")
            if not fs.rename(staged, target):
                fs.rename(old, target)
                raise OSError(f"{new} could not be moved to {path}")
            fs.delete(old, True)
        else:
            fs.mkdirs(target.getParent())
            if not fs.rename(staged, target):
                raise OSError(f"{new} could not be moved to {path}")
    finally:
        delete_paths(spark, [f"{path}.rebuild"])
