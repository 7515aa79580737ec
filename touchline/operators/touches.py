"""The long-form touch table: one row per live visit, cut into chains.

A user's visits, ordered by (time, VisitID), are cut wherever the gap to the
previous visit exceeds the churn threshold D. Each maximal run is a segment
``seg``; ``pos`` is the 1-based position inside it. The chain that ends at a
visit is the prefix of its segment up to that visit, so a row *is* a chain
(length ``pos``) and also an element of every longer chain of its segment.
Every report is computed from these rows with running and suffix windows,
which is linear in the number of visits (the prefix-array form is quadratic).

Ordinary users: all windows partition by (CounterID, UserID) or a superset
of it, so the plan shuffles the visits once by user; each further window
only re-sorts inside the partition.

Hot users (more than ``hot_user_rows`` visits): their rows are cut into time
blocks (``skew.split_hot``) and every window partitions by (user, block).
What crosses a block boundary -- row offset, cut count, the open segment's
start and first source, the last significant / direct-ad source, the next
cut, suffix sums of the segment in later blocks, sources already seen in the
segment -- comes from per-block summaries (one row per block) through
running windows over blocks and a join back on (user, block). No task ever
holds more than one block of a user; the results equal the plain path.
The hot rows are written under ``spark.checkpoint.dir`` after each carry round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.source_code import is_direct, is_direct_click, is_significant
from touchline.functions.time import epoch_seconds
from touchline.operators.skew import AUTO, BLOCK_ROWS, HOT_USER_ROWS, split_hot
from touchline.operators.visits import with_source_code
from touchline.session import checkpointed

USER = ["CounterID", "UserID"]
ORDER = ["ts", "VisitID", "StartDate"]
SEG = USER + ["seg"]

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow

VISIT_COLUMNS = ["CounterID", "UserID", "VisitID", "StartDate", "UTCStartTime", "StartTime", "Duration",
                 "SourceCode", "Conversions", "Revenue", "ts", "local_ts"]
# column -> type of the touch table (both paths produce exactly this)
TOUCH_TYPES = {
    "gap": "long", "cut": "boolean", "seg": "long", "idx": "long", "pos": "long", "seg_len": "long",
    "FirstSource": "string", "LastSignSource": "string", "LastDirectSource": "string",
    "is_conv": "boolean", "suf_n": "long", "suf_cc": "long", "suf_conv": "long",
    "suf_rev": "decimal(28,2)", "lin_n": "double", "lin_conv": "double", "lin_rev": "double",
    "first_in_seg": "boolean", "mid_first": "boolean", "mid_n": "long", "mid_cc": "long",
}


def money(c):
    """Revenue as exact cents for sums (order-independent), back to DOUBLE at the end."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,2)")


def _prepare(visits: DataFrame, with_source: bool, literal_banner_column: bool = False) -> DataFrame:
    v = with_source_code(visits, literal_banner_column) if with_source else visits
    return v.select(
        *USER, "VisitID", "StartDate", "UTCStartTime", "StartTime", "Duration", "SourceCode",
        # a visit table from elsewhere may hold NULL for "none"; one NULL would void its whole chain's credit
        F.coalesce("Conversions", F.lit(0)).alias("Conversions"), F.coalesce("Revenue", F.lit(0.0)).alias("Revenue"),
        epoch_seconds("UTCStartTime").alias("ts"), epoch_seconds("StartTime").alias("local_ts"),
    )


#: The columns of TOUCH_TYPES that a row has before the credits.
SEGMENT_COLUMNS = ["gap", "cut", "seg", "idx", "pos", "seg_len", "FirstSource", "LastSignSource", "LastDirectSource"]


def _finish(df: DataFrame, credits: bool = True) -> DataFrame:
    return df.select(*VISIT_COLUMNS, *[F.col(c).cast(t).alias(c) for c, t in TOUCH_TYPES.items()
                                       if credits or c in SEGMENT_COLUMNS])


def touches(visits: DataFrame, max_gap: float | None, exact_ad_prefix: bool = False,
            with_source: bool = True, hot_user_rows: int | None = HOT_USER_ROWS,
            block_rows: int = BLOCK_ROWS, hot=AUTO, literal_banner_column: bool = False,
            credits: bool = True) -> DataFrame:
    """visits -> touch table (one row per visit).

    Columns: the visit's CounterID, UserID, VisitID, StartDate, UTCStartTime,
    StartTime, Duration, SourceCode, Conversions, Revenue, ts / local_ts
    (epoch s), and

    * gap (s since the user's previous visit), cut (gap > D), seg, idx (row
      number in the user), pos (in the segment), seg_len;
    * FirstSource, LastSignSource, LastDirectSource of the chain ending here;
    * for the row as element k of the chains ending at j >= k in its segment:
      suf_n (how many), suf_cc (how many convert), suf_conv / suf_rev (their
      Conversions / Revenue), lin_n / lin_conv / lin_rev (sums of 1/j,
      Conversions_j/j, Revenue_j/j -- the linear credit);
    * first_in_seg (first occurrence of the source in the segment),
      mid_first (first occurrence at a position >= 2) with mid_n / mid_cc
      (chains of length > 3 containing it at a middle position).

    ``max_gap`` is D (None: no cuts). The cut test is ``gap > D`` on the
    untruncated D. ``hot_user_rows=None`` disables the blocked path; ``hot``
    may pass a precomputed hot-user frame (or None) instead of finding it.
    ``literal_banner_column=True`` builds ``3_1_<type>`` codes from the column
    the source system actually stored in the banner slot (RecommendationSystemID).
    ``credits=False`` ends at the segments (the columns up to LastDirectSource), which is all that chains
    read: the hot path stores its rows between rounds, so Spark cannot leave out the others by itself.
    """
    v = _prepare(visits, with_source, literal_banner_column)
    normal, hot = split_hot(v, USER, hot_user_rows, block_rows, hot=hot)
    out = _touches_plain(normal, max_gap, exact_ad_prefix)
    out = _finish(_credits_plain(out) if credits else out, credits)
    if hot is not None:
        hot = _touches_blocked(hot, max_gap, exact_ad_prefix)
        out = out.unionByName(_finish(_credits_blocked(hot) if credits else hot, credits))
    return out


# -- plain path: one window partition per user ------------------------------

def _cut(gap_col, max_gap):
    if max_gap is None:
        return F.lit(False)
    return F.coalesce(gap_col > F.lit(float(max_gap)), F.lit(False))


def _touches_plain(v: DataFrame, max_gap: float | None, exact_ad_prefix: bool) -> DataFrame:
    w_user = Window.partitionBy(*USER).orderBy(*ORDER)
    v = v.withColumn("gap", F.col("ts") - F.lag("ts").over(w_user))
    v = v.withColumn("cut", _cut(F.col("gap"), max_gap))
    v = v.select("*", F.sum(F.col("cut").cast("long")).over(w_user.rowsBetween(_UNB, _CUR)).alias("seg"),
                 F.row_number().over(w_user).alias("idx"))

    w_seg = Window.partitionBy(*SEG).orderBy(*ORDER)
    run = w_seg.rowsBetween(_UNB, _CUR)
    code = F.col("SourceCode")
    last_of = lambda cond: F.last(F.when(cond, code), ignorenulls=True).over(run)
    sig = last_of(is_significant(code))
    return v.select(
        "*",
        F.row_number().over(w_seg).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy(*SEG)).alias("seg_len"),
        F.first(code).over(run).alias("FirstSource"),
        F.coalesce(sig, code).alias("LastSignSource"),
        F.coalesce(last_of(is_direct_click(code, exact_ad_prefix)), last_of(is_direct(code)),
                   sig, code).alias("LastDirectSource"),
    )


def _credits_plain(t: DataFrame) -> DataFrame:
    # Suffix sums within the segment as (segment total - running sum + own value), both on
    # the segment order the positions already use: no extra sort, linear. (A frame ending
    # at unboundedFollowing would be recomputed per row.) Counts and money are exact;
    # the linear credits differ from a direct suffix sum only in the last bits.
    run = Window.partitionBy(*SEG).orderBy(*ORDER).rowsBetween(_UNB, _CUR)
    whole = Window.partitionBy(*SEG)
    conv = F.col("Conversions")
    is_conv = (conv > 0).cast("long")
    inv = F.lit(1.0) / F.col("pos")
    values = {
        "suf_cc": is_conv, "suf_conv": conv, "suf_rev": money("Revenue"),
        "lin_n": inv, "lin_conv": conv * inv, "lin_rev": F.col("Revenue") * inv,
    }
    t = t.select(
        "*",
        (conv > 0).alias("is_conv"),
        (F.col("seg_len") - F.col("pos") + 1).alias("suf_n"),
        *[(F.sum(x).over(whole) - F.sum(x).over(run) + x).alias(k) for k, x in values.items()],
    )
    w_src = Window.partitionBy(*SEG, "SourceCode").orderBy(*ORDER)
    t = t.select(
        "*",
        F.row_number().over(w_src).alias("src_rn"),
        F.min("pos").over(Window.partitionBy(*SEG, "SourceCode")).alias("src_first_pos"),
        # suffix count of converting chains from position 4 (same for the whole segment)
        F.max(F.when(F.col("pos") == 4, F.col("suf_cc"))).over(Window.partitionBy(*SEG))
        .alias("cc_from_4"),
    )
    pos = F.col("pos")
    mid_first = (pos >= 2) & ((F.col("src_rn") == 1)
                              | ((F.col("src_rn") == 2) & (F.col("src_first_pos") == 1)))
    start = F.greatest(pos + 1, F.lit(4))
    return t.select(
        "*",
        (F.col("src_rn") == 1).alias("first_in_seg"),
        mid_first.alias("mid_first"),
        F.greatest(F.col("seg_len") - start + 1, F.lit(0)).alias("mid_n"),
        F.when(pos == 2, F.coalesce(F.col("cc_from_4"), F.lit(0)))
         .otherwise(F.col("suf_cc") - is_conv).alias("mid_cc"),
    )


# -- blocked path: hot users, one window partition per (user, block) ---------

_BLK = USER + ["blk"]


def _cut_lineage(df: DataFrame) -> DataFrame:
    """Write a round's result to the checkpoint directory and continue from the stored rows.

    Each round joins the rows with a summary computed from the same rows; without
    a cut the plan would repeat the earlier rounds once per reference. The rows
    live under ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost
    executor does not send the job back to the first round.
    """
    return checkpointed(df, "hot-touches")


def _struct_at(cond, idx_col="lidx"):
    return F.when(cond, F.struct(F.col(idx_col).alias("i"), F.col("SourceCode").alias("s")))


def _touches_blocked(h: DataFrame, max_gap: float | None, exact_ad_prefix: bool) -> DataFrame:
    code = F.col("SourceCode")
    sig_c = is_significant(code)
    dc_c = is_direct_click(code, exact_ad_prefix)
    dir_c = is_direct(code)
    wb = Window.partitionBy(*_BLK).orderBy(*ORDER)
    run = wb.rowsBetween(_UNB, _CUR)
    after = (Window.partitionBy(*_BLK).orderBy(*[F.col(c).desc() for c in ORDER])
             .rowsBetween(_UNB, -1))
    by_blk = Window.partitionBy(*USER).orderBy("blk")
    prev_blks = by_blk.rowsBetween(_UNB, -1)
    next_blks = Window.partitionBy(*USER).orderBy(F.col("blk").desc()).rowsBetween(_UNB, -1)

    # round 1: inside the block (the block's first row does not know its gap yet)
    h = h.withColumn("lidx", F.row_number().over(wb))
    h = h.withColumn("lgap", F.col("ts") - F.lag("ts").over(wb))
    h = h.withColumn("lcut", _cut(F.col("lgap"), max_gap))
    h = h.withColumn("is_conv", F.col("Conversions") > 0)
    h = h.select(
        "*",
        F.sum(F.col("lcut").cast("long")).over(run).alias("lcuts_run"),
        F.max(F.when(F.col("lcut"), F.col("lidx"))).over(run).alias("lcut_at"),
        F.last(F.when(F.col("lcut"), code), ignorenulls=True).over(run).alias("lcut_src"),
        F.min(F.when(F.col("lcut"), F.col("lidx"))).over(after).alias("lnext_cut"),
        F.lead(F.col("is_conv").cast("long")).over(wb).alias("lnext_conv"),
        F.last(_struct_at(sig_c), ignorenulls=True).over(run).alias("lsig"),
        F.last(_struct_at(dc_c), ignorenulls=True).over(run).alias("ldc"),
        F.last(_struct_at(dir_c), ignorenulls=True).over(run).alias("ldir"),
    )

    # per-block summary and the state carried into each block
    s1 = h.groupBy(*_BLK).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum(F.col("lcut").cast("long")).alias("ncut_local"),
        F.max(_struct_at(F.col("lcut"))).alias("last_cut"),
        F.min(F.when(F.col("lcut"), F.col("lidx"))).alias("first_cut_local"),
        F.max(F.when(F.col("lidx") == 1, code)).alias("first_src"),
        F.max(F.when(F.col("lidx") == 1, F.col("is_conv").cast("long"))).alias("first_conv"),
        F.max(_struct_at(sig_c)).alias("bsig"), F.max(_struct_at(dc_c)).alias("bdc"),
        F.max(_struct_at(dir_c)).alias("bdir"),
    )
    c = s1.select(
        "*",
        F.coalesce(F.sum("n").over(prev_blks), F.lit(0)).alias("rows_before"),
        F.lag("last_ts").over(by_blk).alias("prev_last_ts"),
        F.sum("n").over(Window.partitionBy(*USER)).alias("n_user"),
        F.first("first_src").over(by_blk.rowsBetween(_UNB, _CUR)).alias("user_first_src"),
    )
    c = c.withColumn("fcut", _cut(F.col("first_ts") - F.col("prev_last_ts"), max_gap))
    c = c.withColumn("cuts_in", F.col("ncut_local") + F.col("fcut").cast("long"))
    glob = lambda st: F.when(F.col(st).isNotNull(), F.struct(
        (F.col("rows_before") + F.col(st)["i"]).alias("i"), F.col(st)["s"].alias("s")))
    c = c.select(
        "*",
        F.coalesce(F.sum("cuts_in").over(prev_blks), F.lit(0)).alias("cuts_before"),
        F.when(F.col("last_cut").isNotNull(),
               F.struct((F.col("rows_before") + F.col("last_cut")["i"]).alias("i"),
                        F.col("last_cut")["s"].alias("s")))
         .when(F.col("fcut"), F.struct((F.col("rows_before") + 1).alias("i"), F.col("first_src").alias("s")))
         .alias("blast_cut"),
        F.when(F.col("fcut"), F.col("rows_before") + 1)
         .otherwise(F.col("rows_before") + F.col("first_cut_local")).alias("bfirst_cut"),
        glob("bsig").alias("gsig"), glob("bdc").alias("gdc"), glob("bdir").alias("gdir"),
    )
    c = c.select(
        *_BLK, "rows_before", "prev_last_ts", "n_user", "fcut", "cuts_before", "first_src",
        (F.col("cuts_before") + F.col("cuts_in")).alias("last_seg"),
        F.last("blast_cut", ignorenulls=True).over(prev_blks).alias("open_cut"),
        "user_first_src",
        F.last("gsig", ignorenulls=True).over(prev_blks).alias("sig_before"),
        F.last("gdc", ignorenulls=True).over(prev_blks).alias("dc_before"),
        F.last("gdir", ignorenulls=True).over(prev_blks).alias("dir_before"),
        F.min("bfirst_cut").over(next_blks).alias("next_cut_after"),
        F.lead("first_conv").over(by_blk).alias("next_first_conv"),
    )
    h = _cut_lineage(h.join(c, _BLK, "inner"))

    # global per-row values
    rb = F.col("rows_before")
    lc = F.coalesce(F.col("lcut_at"), F.when(F.col("fcut"), F.lit(1)))
    seg_start = F.when(lc.isNotNull(), rb + lc).otherwise(F.coalesce(F.col("open_cut")["i"], F.lit(1)))
    h = h.select(
        "*",
        (F.col("lcut") | ((F.col("lidx") == 1) & F.col("fcut"))).alias("cut"),
        F.when(F.col("lidx") == 1, F.col("ts") - F.col("prev_last_ts")).otherwise(F.col("lgap")).alias("gap"),
        (F.col("cuts_before") + F.col("fcut").cast("long") + F.col("lcuts_run")).alias("seg"),
        (rb + F.col("lidx")).alias("idx"),
        seg_start.alias("seg_start"),
    )

    def pick(local, carry):
        ss = F.col("seg_start")
        return (F.when(F.col(local).isNotNull() & (rb + F.col(local)["i"] >= ss), F.col(local)["s"])
                .when(F.col(carry).isNotNull() & (F.col(carry)["i"] >= ss), F.col(carry)["s"]))

    sig = pick("lsig", "sig_before")
    next_cut = F.when(F.col("lnext_cut").isNotNull(), rb + F.col("lnext_cut")).otherwise(F.col("next_cut_after"))
    return h.select(
        "*",
        (F.col("idx") - F.col("seg_start") + 1).alias("pos"),
        (F.coalesce(next_cut, F.col("n_user") + 1) - F.col("seg_start")).alias("seg_len"),
        F.when(F.col("lcut_at").isNotNull(), F.col("lcut_src")).when(F.col("fcut"), F.col("first_src"))
         .otherwise(F.coalesce(F.col("open_cut")["s"], F.col("user_first_src"))).alias("FirstSource"),
        F.coalesce(sig, code).alias("LastSignSource"),
        F.coalesce(pick("ldc", "dc_before"), pick("ldir", "dir_before"), sig, code).alias("LastDirectSource"),
    )


def _credits_blocked(h: DataFrame) -> DataFrame:
    code = F.col("SourceCode")
    by_blk = Window.partitionBy(*USER).orderBy("blk")

    # round 2: suffix sums inside the block, plus the segment's rows in later blocks
    inv = F.lit(1.0) / F.col("pos")
    values = {
        "suf_cc": F.col("is_conv").cast("long"),
        "suf_conv": F.col("Conversions").cast("long"),
        "suf_rev": money("Revenue"),
        "lin_n": inv,
        "lin_conv": F.col("Conversions") * inv,
        "lin_rev": F.col("Revenue") * inv,
    }
    w_rev = (Window.partitionBy(*_BLK, "seg").orderBy(*[F.col(c).desc() for c in ORDER])
             .rowsBetween(_UNB, _CUR))
    h = h.select("*", *[x.alias(f"v_{k}") for k, x in values.items()])
    h = h.select("*", *[F.sum(f"v_{k}").over(w_rev).alias(f"l_{k}") for k in values])
    head = F.col("seg") == F.col("cuts_before")
    zero = {"suf_rev": F.lit(0).cast("decimal(18,2)"), "lin_n": F.lit(0.0), "lin_conv": F.lit(0.0),
            "lin_rev": F.lit(0.0)}
    s2 = h.groupBy(*_BLK).agg(
        F.max("cuts_before").alias("cuts_before"),
        *[F.sum(F.when(head, F.col(f"v_{k}")).otherwise(zero.get(k, F.lit(0).cast("long")))).alias(f"h_{k}")
          for k in values])
    grp = Window.partitionBy(*USER, "cuts_before").orderBy(F.col("blk").desc()).rowsBetween(_UNB, _CUR)
    s2 = s2.select(*_BLK, *[F.sum(f"h_{k}").over(grp).alias(f"g_{k}") for k in values])
    s2 = s2.select(*_BLK, *[F.lead(f"g_{k}").over(by_blk).alias(f"later_{k}") for k in values])
    h = h.join(s2, _BLK, "inner")
    tail = F.col("seg") == F.col("last_seg")
    h = h.select("*", *[(F.col(f"l_{k}") + F.when(tail, F.coalesce(F.col(f"later_{k}"), zero.get(k, F.lit(0))))
                         .otherwise(zero.get(k, F.lit(0)))).alias(k) for k in values])
    # first occurrence of a source inside the block's part of its segment (and among positions >= 2)
    w_src = Window.partitionBy(*_BLK, "seg", "SourceCode").orderBy(*ORDER)
    h = h.select(
        "*",
        (F.row_number().over(w_src) == 1).alias("lfirst"),
        ((F.col("pos") >= 2)
         & (F.sum((F.col("pos") >= 2).cast("long")).over(w_src.rowsBetween(_UNB, _CUR)) == 1)).alias("lmid"),
    )
    h = _cut_lineage(h)

    # round 3: first occurrence of a source in its segment (and among positions >= 2) across
    # blocks; the in-block flags were computed before the checkpoint above

    def seen_earlier(flag: str, name: str) -> DataFrame:
        # (seg, source) pairs of a block whose first occurrence is in an earlier block; only the
        # segment open at the block start can have any, and each block adds at most one record
        # per (segment, source), so no key grows beyond the number of blocks.
        cand = h.where(F.col(flag)).select(*_BLK, "seg", "SourceCode")
        first_blk = cand.groupBy(*USER, "seg", "SourceCode").agg(F.min("blk").alias("fb"))
        return (cand.join(first_blk, USER + ["seg", "SourceCode"], "inner")
                .where(F.col("blk") > F.col("fb"))
                .groupBy(*_BLK).agg(F.collect_set("SourceCode").alias(name)))

    h = (h.join(seen_earlier("lfirst", "seen"), _BLK, "left")
         .join(seen_earlier("lmid", "seen_mid"), _BLK, "left"))
    in_head = F.col("seg") == F.col("cuts_before")
    seen = lambda col: in_head & F.coalesce(F.array_contains(F.col(col), code), F.lit(False))
    pos = F.col("pos")
    is_conv = F.col("is_conv").cast("long")
    next_conv = F.when(F.col("seg_len") >= 3, F.coalesce(F.col("lnext_conv"), F.col("next_first_conv")))
    return h.select(
        "*",
        (F.col("seg_len") - pos + 1).alias("suf_n"),
        (F.col("lfirst") & ~seen("seen")).alias("first_in_seg"),
        (F.col("lmid") & ~seen("seen_mid")).alias("mid_first"),
        F.greatest(F.col("seg_len") - F.greatest(pos + 1, F.lit(4)) + 1, F.lit(0)).alias("mid_n"),
        F.when(pos == 2, F.col("suf_cc") - is_conv - F.coalesce(next_conv, F.lit(0)))
         .otherwise(F.col("suf_cc") - is_conv).alias("mid_cc"),
    )
