"""Source-name dimension: SourceCode -> SourceName (a small lookup table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.schema import SOURCE_NAMES
from touchline.sources.tsv import read_tsv

# Fixed value: label of a code missing from the names table.
UNKNOWN_SOURCE_NAME = "Неизвестный источник"


def read_source_names(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated file with header ``SourceCode<TAB>SourceName``; codes stay text."""
    return read_tsv(spark, path, SOURCE_NAMES)


def no_source_names(spark: SparkSession) -> DataFrame:
    """An empty names table: every code gets the unknown label."""
    return spark.createDataFrame([], SOURCE_NAMES)
