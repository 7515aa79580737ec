"""Per-source measures of all reports in one pass, and the position metrics.

``source_measures`` explodes each touch row into four (source, measures)
records -- its own source, the segment's first source, the last significant
and the last direct-ad source -- and aggregates them by source once. The
partial aggregation before the shuffle leaves at most one record per source
and task, so even a source holding most touches costs one small record per
task. The result has one row per distinct source code (a few hundred at
most), so the global totals are read from it with an unpartitioned window.

Position metrics (shares, 0 when the denominator is 0):

* in_chain_perc_total      touches of the source / all touches of all chains;
* unique_chains_perc       chains containing the source / chains;
* first_touch_total/_2plus chains whose first source it is / chains (of length > 1);
* mid_touch_3plus          chains of length > 3 containing it at a middle
                           position / chains of length > 3;
* last_touch_total/_2plus  chains ending with it / chains (of length > 1);
and the same over converting chains (chain's last visit has Conversions > 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.touches import money


def _zero_l():
    return F.lit(0).cast("long")


def _zero_d():
    return F.lit(0.0)


def _zero_m():
    return F.lit(0).cast("decimal(18,2)")


def _measures():
    """name -> (role, expression); roles: own, first, sig, direct."""
    return {
        "last_n": ("own", F.lit(1).cast("long")),
        "last_conv": ("own", F.col("Conversions").cast("long")),
        "last_rev": ("own", money("Revenue")),
        "last_cc": ("own", F.col("is_conv").cast("long")),
        "last2_n": ("own", (F.col("pos") > 1).cast("long")),
        "last2_cc": ("own", (F.col("is_conv") & (F.col("pos") > 1)).cast("long")),
        "len4_n": ("own", (F.col("pos") > 3).cast("long")),
        "len4_cc": ("own", (F.col("is_conv") & (F.col("pos") > 3)).cast("long")),
        "lin_n": ("own", F.col("lin_n")),
        "lin_conv": ("own", F.col("lin_conv")),
        "lin_rev": ("own", F.col("lin_rev")),
        "w_n": ("own", F.col("suf_n")),
        "w_cc": ("own", F.col("suf_cc")),
        "assoc_n": ("own", F.when(F.col("first_in_seg"), F.col("suf_n")).otherwise(_zero_l())),
        "assoc_conv": ("own", F.when(F.col("first_in_seg"), F.col("suf_conv")).otherwise(_zero_l())),
        "assoc_rev": ("own", F.when(F.col("first_in_seg"), F.col("suf_rev")).otherwise(_zero_m())),
        "assoc_cc": ("own", F.when(F.col("first_in_seg"), F.col("suf_cc")).otherwise(_zero_l())),
        "mid_n": ("own", F.when(F.col("mid_first"), F.col("mid_n")).otherwise(_zero_l())),
        "mid_cc": ("own", F.when(F.col("mid_first"), F.col("mid_cc")).otherwise(_zero_l())),
        "first_n": ("first", F.lit(1).cast("long")),
        "first_conv": ("first", F.col("Conversions").cast("long")),
        "first_rev": ("first", money("Revenue")),
        "first_cc": ("first", F.col("is_conv").cast("long")),
        "first2_n": ("first", (F.col("pos") > 1).cast("long")),
        "first2_cc": ("first", (F.col("is_conv") & (F.col("pos") > 1)).cast("long")),
        "sig_n": ("sig", F.lit(1).cast("long")),
        "sig_conv": ("sig", F.col("Conversions").cast("long")),
        "sig_rev": ("sig", money("Revenue")),
        "dir_n": ("direct", F.lit(1).cast("long")),
        "dir_conv": ("direct", F.col("Conversions").cast("long")),
        "dir_rev": ("direct", money("Revenue")),
    }


_ROLE_KEY = {"own": "SourceCode", "first": "FirstSource", "sig": "LastSignSource",
             "direct": "LastDirectSource"}
_DOUBLE = {"lin_n", "lin_conv", "lin_rev"}
_MONEY = {"last_rev", "assoc_rev", "first_rev", "sig_rev", "dir_rev"}


def _zero(name):
    if name in _DOUBLE:
        return _zero_d()
    return _zero_m() if name in _MONEY else _zero_l()


def _cast(name, c):
    if name in _DOUBLE:
        return c.cast("double")
    if name in _MONEY:
        return c.cast("decimal(18,2)")
    return c.cast("long")


def source_measures(credits: DataFrame) -> DataFrame:
    """touch table -> one row per SourceCode with every raw measure and the totals."""
    measures = _measures()
    records = []
    for role, key in _ROLE_KEY.items():
        fields = [F.col(key).alias("SourceCode")]
        for name, (r, expr) in measures.items():
            fields.append(_cast(name, expr if r == role else _zero(name)).alias(name))
        records.append(F.struct(*fields))
    exploded = credits.select(F.explode(F.array(*records)).alias("r")).select("r.*")
    sums = []
    for name in measures:
        s = F.sum(name)
        if name in _MONEY:
            s = s.cast("double")
        sums.append(s.alias(name))
    per_source = exploded.groupBy("SourceCode").agg(*sums)
    everything = Window.partitionBy()  # one row per source code: a bounded, tiny table
    totals = {
        "tot_chains": "last_n", "tot_conv_chains": "last_cc",
        "tot_chains_2": "last2_n", "tot_conv_chains_2": "last2_cc",
        "tot_chains_4": "len4_n", "tot_conv_chains_4": "len4_cc",
        "tot_touches": "w_n", "tot_conv_touches": "w_cc",
    }
    return per_source.select(
        "*", *[F.sum(src).over(everything).alias(name) for name, src in totals.items()])


def share(num, den):
    """num / den as DOUBLE, 0 when den is 0 (0/0 in the source system became NaN, then 0)."""
    return F.coalesce(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")), _zero_d())


# report column -> (numerator, denominator); the presence column says which
# sources the stand-alone part query would list.
POSITION_PARTS = {
    "pos_weight": ("w_n", [("in_chain_perc_total", "w_n", "tot_touches"),
                           ("in_conv_chains_perc_total", "w_cc", "tot_conv_touches")]),
    "pos_unique_chains": ("assoc_n", [("unique_chains_perc", "assoc_n", "tot_chains"),
                                      ("unique_conv_chains_perc", "assoc_cc", "tot_conv_chains")]),
    "pos_first_2plus": ("first2_n", [("first_touch_2plus", "first2_n", "tot_chains_2"),
                                     ("first_touch_conv_2plus", "first2_cc", "tot_conv_chains_2")]),
    "pos_first_all": ("first_n", [("first_touch_total", "first_n", "tot_chains"),
                                  ("first_touch_conv_total", "first_cc", "tot_conv_chains")]),
    "pos_middle": ("mid_n", [("mid_touch_3plus", "mid_n", "tot_chains_4"),
                             ("mid_touch_conv_3plus", "mid_cc", "tot_conv_chains_4")]),
    "pos_last_2plus": ("last2_n", [("last_touch_2plus", "last2_n", "tot_chains_2"),
                                   ("last_touch_conv_2plus", "last2_cc", "tot_conv_chains_2")]),
    "pos_last_all": ("last_n", [("last_touch_total", "last_n", "tot_chains"),
                                ("last_touch_conv_total", "last_cc", "tot_conv_chains")]),
}

# The parts in the order of the display tables.
_DISPLAYED = ["pos_weight", "pos_unique_chains", "pos_first_all", "pos_first_2plus", "pos_middle", "pos_last_all",
              "pos_last_2plus"]


def displayed_columns(converting: bool = False) -> list[str]:
    """Metric columns of the chains display table, over all chains or over converting ones."""
    return [POSITION_PARTS[part][1][int(converting)][0] for part in _DISPLAYED]



def position_part(measures: DataFrame, part: str) -> DataFrame:
    """One of the seven position metric pairs, listing only sources that occur in that part."""
    presence, cols = POSITION_PARTS[part]
    return measures.where(F.col(presence) > 0).select(
        "SourceCode", *[share(n, d).alias(name) for name, n, d in cols])


def position_metrics(measures: DataFrame) -> DataFrame:
    cols = [share(n, d).alias(name) for _, parts in POSITION_PARTS.values() for name, n, d in parts]
    return measures.select("SourceCode", *cols)
