"""Session helper: the settings the plans rely on."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                app_name: str = "touchline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE on and the UI off.

    ``master=None`` keeps the master the launcher configured (spark-submit),
    falling back to ``local[*]`` only when none is set; ``shuffle_partitions=None``
    keeps the configured number. A checkpoint directory is set only when the
    cluster has not named one; on a cluster ``spark.checkpoint.dir`` must
    point at shared storage.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    else:
        from pyspark import SparkConf, SparkContext
        SparkContext._ensure_initialized()   # attach to the launcher's JVM so its settings are visible
        if not SparkConf().contains("spark.master"):
            builder = builder.master("local[*]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory (``spark.checkpoint.dir``).

    On a cluster it must name shared storage and is only read here. A local
    session (tests, benchmarks) without one gets a scratch directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared directory (HDFS/S3/...) "
                               "for checkpoints on a cluster")
        current = tempfile.mkdtemp(prefix="touchline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def checkpointed(df, name: str = "stage"):
    """``df`` written as parquet under the checkpoint directory, continuing from the stored rows.

    One job computes and writes the rows (no cached copy held in executor
    memory); the returned frame reads them back, so its lineage starts at
    shared storage and a lost executor never sends the job back further.
    """
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/touchline/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    for paths in _recorders:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)     # no job to look the schema up


_recorders: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]):
    """Note in ``paths`` what ``checkpointed`` writes inside, for ``delete_paths``."""
    _recorders.append(paths)
    try:
        yield paths
    finally:        # this list, not one that is equal to it
        del _recorders[next(i for i, own in enumerate(_recorders) if own is paths)]


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders on whatever file system they are on."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    paths.clear()


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of raw visits on ``total_cores`` cores.

    * scan splits of at most 256 MB (``spark.sql.files.maxPartitionBytes``);
    * shuffle partitions so that one holds about ``target_partition_bytes`` of
      the widest shuffle (the narrow visit rows are a fraction of the raw rows,
      so this errs on the small side), never fewer than 3 waves of the cores;
    * AQE on, with partition coalescing and skew splitting for joins, so a
      badly sized number is corrected at run time.
    ``spark.checkpoint.dir`` must additionally name shared storage.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
