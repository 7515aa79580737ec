"""Positional attribution models and associated conversions (per source).

Each model gives every visit-ended chain (one touch row) to one source, or
spreads it over the chain's elements, and sums visits, Conversions and
Revenue of the chain's last visit:

* last click       -> the chain's last source;
* first click      -> the segment's first source;
* last significant -> the last source not in (0, -1, 4, 5, 6), else the last;
* last direct ad   -> the last ``3_1_%`` source, else the last ``3_1``, else
                      the last significant, else the last;
* linear           -> each of the n elements gets 1/n;
* associated       -> each distinct source of the chain gets full credit.

Money is summed as exact DECIMAL cents and returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.touches import money


def _by_source(t: DataFrame, key: str, prefix: str) -> DataFrame:
    return t.groupBy(F.col(key).alias("SourceCode")).agg(
        F.count(F.lit(1)).alias(f"{prefix}Visits"),
        F.sum("Conversions").cast("long").alias(f"{prefix}Convs"),
        F.sum(money("Revenue")).cast("double").alias(f"{prefix}Revenue"),
    )


def attr_last_click(t: DataFrame) -> DataFrame:
    return _by_source(t, "SourceCode", "LastClick")


def attr_first_click(t: DataFrame) -> DataFrame:
    return _by_source(t, "FirstSource", "FirstClick")


def attr_last_significant(t: DataFrame) -> DataFrame:
    return _by_source(t, "LastSignSource", "LastSignClick")


def attr_last_direct(t: DataFrame) -> DataFrame:
    return _by_source(t, "LastDirectSource", "LastSignDirect")


def attr_linear(credits: DataFrame) -> DataFrame:
    """credits = the touch table (``touches``)."""
    return credits.groupBy("SourceCode").agg(
        F.sum("lin_n").alias("LinearAttrVisits"),
        F.sum("lin_conv").alias("LinearAttrConvs"),
        F.sum("lin_rev").alias("LinearAttrRevenue"),
    )


def associated(credits: DataFrame) -> DataFrame:
    """A source's first occurrence at position f of a segment is in every chain ending at j >= f."""
    return credits.where("first_in_seg").groupBy("SourceCode").agg(
        F.sum("suf_n").cast("long").alias("AssociatedVisits"),
        F.sum("suf_conv").cast("long").alias("AssociatedConvs"),
        F.sum("suf_rev").cast("double").alias("AssociatedRevenue"),
    )
