"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regex class of the six ASCII white-space characters; everything else belongs to words.
SPACE = r"[\x20\x09-\x0D]"
ASCII_SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; extra columns cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def free(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


_handed_out: set[str] = set()


def shipped(frame: DataFrame) -> DataFrame:
    """``frame``, once Python workers can import this package: where it is neither in their path nor in the
    working directory, Spark hands out a copy of it."""
    context = frame.sparkSession.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = {os.path.abspath(p) for p in ["", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]}
    if root not in known and context.applicationId not in _handed_out:
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="touchline-"), "touchline"), "zip", root,
                                   "touchline")
        context.addPyFile(made)
        _handed_out.add(context.applicationId)
    return frame


def words(text: str | Column) -> Column:
    """Array of the words (runs without ASCII white space) of a text; empty for null or blank texts."""
    trimmed = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(ASCII_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def mix64(x):
    """Finaliser of 64-bit hashes in a numpy array (a bijection that spreads every bit)."""
    import numpy as np
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives through many tasks, and what one of them has
    freed would else count against the executor for good."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about ``max_bytes`` of ``column`` (or a single row): bounds Python's memory."""
    import numpy as np
    import pyarrow.compute as pc
    batch = sizes = None
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // max_bytes if len(sizes) else sizes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    del batch, sizes
    give_back()
