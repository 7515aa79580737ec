"""Wide per-source reports: merge of the parts, source names, top-k display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.formats import percent_text, thousands_text
from touchline.operators.positions import displayed_columns
from touchline.sources.names import UNKNOWN_SOURCE_NAME

SIMPLE_COLUMNS = {
    "LastClickVisits": "last_n", "LastClickConvs": "last_conv", "LastClickRevenue": "last_rev",
    "FirstClickVisits": "first_n", "FirstClickConvs": "first_conv", "FirstClickRevenue": "first_rev",
    "LastSignClickVisits": "sig_n", "LastSignClickConvs": "sig_conv", "LastSignClickRevenue": "sig_rev",
    "LastSignDirectVisits": "dir_n", "LastSignDirectConvs": "dir_conv",
    "LastSignDirectRevenue": "dir_rev",
    "LinearAttrVisits": "lin_n", "LinearAttrConvs": "lin_conv", "LinearAttrRevenue": "lin_rev",
}
ASSOCIATED_COLUMNS = {
    "AssociatedVisits": "assoc_n", "AssociatedConvs": "assoc_conv", "AssociatedRevenue": "assoc_rev",
}


def with_names(report: DataFrame, names: DataFrame, default: str = UNKNOWN_SOURCE_NAME) -> DataFrame:
    """Left join to the names table; codes without a name get ``default``.

    The names table is a fixed dimension (one row per known code, ~100
    rows); Spark broadcasts it from its measured size (autoBroadcastJoinThreshold),
    and a names table too large for that falls back to a shuffle join.
    Duplicates are dropped first so a join can never multiply report rows.
    """
    dim = names.select("SourceCode", "SourceName").dropDuplicates(["SourceCode"])
    return (report.join(dim, "SourceCode", "left")
            .withColumn("SourceName", F.coalesce(F.col("SourceName"), F.lit(default))))


def simple_attributions(measures: DataFrame) -> DataFrame:
    """Five models side by side; a source missing from a model has 0 there."""
    return measures.select("SourceCode", *[F.col(src).alias(name) for name, src in SIMPLE_COLUMNS.items()])


def associated_conversions(measures: DataFrame) -> DataFrame:
    return measures.where(F.col("assoc_n") > 0).select(
        "SourceCode", *[F.col(src).alias(name) for name, src in ASSOCIATED_COLUMNS.items()])


def top_sources_report(report: DataFrame, metric: str, k: int = 10,
                       columns: Sequence[str] | None = None,
                       labels: dict[str, str] | None = None,
                       formats: dict[str, str] | None = None) -> DataFrame:
    """The top k sources by ``metric`` (descending; ties by SourceCode), for display.

    ``formats`` maps a column to ``"thousands"`` (1,234), ``"money"`` (1,234.5)
    or ``"percent"`` (12.35%); ``labels`` renames columns. Runs as one
    TakeOrderedAndProject: each task keeps k rows, the driver merges them.
    """
    top = report.orderBy(F.col(metric).desc(), F.col("SourceCode").asc()).limit(k)
    columns = list(columns) if columns else report.columns
    formats = formats or {}
    labels = labels or {}
    out = []
    for c in columns:
        kind = formats.get(c)
        if kind == "thousands":
            e = thousands_text(c, 0)
        elif kind == "money":
            e = thousands_text(c, 2)
        elif kind == "percent":
            e = percent_text(c, 2)
        else:
            e = F.col(c)
        out.append(e.alias(labels.get(c, c)))
    return top.select(*out)


def top_associated(report: DataFrame, k: int = 10, labels: dict[str, str] | None = None) -> DataFrame:
    """The display table of associated conversions."""
    kinds = dict(zip(ASSOCIATED_COLUMNS, ("thousands", "thousands", "money")))
    return top_sources_report(report, "AssociatedConvs", k, ["SourceName", *kinds], labels, kinds)


def top_chains(report: DataFrame, converting: bool = False, k: int = 10,
               labels: dict[str, str] | None = None) -> DataFrame:
    """The display table of position shares, by the share of unique (converting) chains."""
    cols = displayed_columns(converting)
    return top_sources_report(report, cols[1], k, ["SourceName", *cols], labels, {c: "percent" for c in cols})
