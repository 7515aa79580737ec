"""Churn markers, visits ahead, and the chain table.

A chain element is a visit (``2_VISIT``) or a churn marker (``0_NULL``). A
gap marker sits int(D) seconds after the visit before a cut; a trailing
marker sits int(D) seconds after the user's last visit and is kept when its
local date is within the period. Markers sort before visits of the same
second.

Every element ends one chain: the elements of its segment up to and
including itself. Storing that prefix on every row (the history arrays of
the original table) would emit every pair of elements of a segment -- n^2
per segment. The chain table here stores each element once with ``chain``
(its segment) and ``pos`` (its place in it); the history of the chain that
ends at a row is exactly the rows of the same (CounterID, UserID, chain)
with ``pos`` up to its own (``history_of``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.time import ntz_from_seconds
from touchline.operators.asof import asof_last
from touchline.operators.skew import AUTO, BLOCK_ROWS, HOT_USER_ROWS, resolve_hot, rows_before
from touchline.operators.touches import USER
from touchline.session import checkpointed

VISIT = "2_VISIT"
CHURN = "0_NULL"
CHURN_CODE = "null"


def _timeline(t: DataFrame, d: int, end_date) -> DataFrame:
    """Visits and churn markers of ordinary users in one frame, from user windows alone.

    Every visit emits itself, the gap marker before it where a cut precedes it, and the trailing marker
    after the user's last visit. A gap marker takes the k-th smallest local time of the user, k being the
    UTC rank of the visit before the cut: both are put on one rank axis, where the marker reads the visit
    with its rank. All windows partition by (CounterID, UserID): one exchange, no join.
    """
    w = Window.partitionBy(*USER)
    t = t.select("*", F.lag("pos").over(w.orderBy("idx")).alias("_prev_pos"),
                 F.lead("idx").over(w.orderBy("idx")).isNull().alias("_last"),
                 F.row_number().over(w.orderBy("local_ts", "VisitID", "StartDate")).alias("_rank"),
                 F.max("local_ts").over(w).alias("_max_local"))
    tail_local = F.col("_max_local") + d
    tail = F.col("_last") & (F.to_date(ntz_from_seconds(tail_local)) <= F.lit(end_date).cast("date"))

    def row(kind, rank, seg, pos, ts, local_ts):
        return F.struct(F.lit(kind).alias("kind"), rank.cast("long").alias("rank"), seg.alias("seg"),
                        pos.cast("long").alias("pos"), ts.alias("ts"), local_ts.cast("long").alias("local_ts"))

    none = F.lit(None)
    rows = F.array(
        row("visit", F.col("_rank"), F.col("seg"), F.col("pos"), F.col("ts"), F.col("local_ts")),
        F.when(F.col("cut"), row("gap", F.col("idx") - 1, F.col("seg") - 1, F.col("_prev_pos") + 1,
                                 F.col("ts") - F.col("gap") + d, none)),
        F.when(tail, row("tail", none, F.col("seg"), F.col("pos") + 1, F.col("ts") + d, tail_local)))
    both = t.select(*USER, "idx", "VisitID", "StartDate", "SourceCode", "Duration", "Conversions", "Revenue",
                    F.explode(F.array_compact(rows)).alias("_row"))
    # visits before markers of the same rank
    at = w.orderBy("_row.rank", F.col("_row.kind").desc()).rowsBetween(Window.unboundedPreceding, 0)
    paired = F.last(F.when(F.col("_row.kind") == "visit", F.col("_row.local_ts")), ignorenulls=True).over(at)
    local = F.when(F.col("_row.kind") == "gap", paired + d).otherwise(F.col("_row.local_ts"))
    both = both.select("*", local.alias("_local"))
    return both.select(*_element_columns(F.col("_row.kind"), "_row.seg", "_row.pos", "_row.ts", "_local"))


def _element_columns(kind, seg, pos, ts, local) -> list:
    visit = kind == "visit"
    own = lambda c, default: F.when(visit, F.col(c)).otherwise(F.lit(default))
    return [*USER, F.col(seg).alias("seg"), F.col(pos).cast("long").alias("pos"), own("VisitID", 0).alias("VisitID"),
            own("SourceCode", CHURN_CODE).alias("SourceCode"), F.col(ts).alias("ts"), F.col(local).alias("local_ts"),
            F.when(visit, VISIT).otherwise(CHURN).alias("EventType"),
            own("Duration", 0).cast("long").alias("Duration"), own("Conversions", 0).cast("long").alias("Conversions"),
            own("Revenue", 0.0).cast("double").alias("Revenue"), own("idx", 0).cast("long").alias("idx"),
            F.when(~visit, kind).alias("marker")]


def _hot_markers(t: DataFrame, d: int, end_date, hot: DataFrame, block_rows: int) -> DataFrame:
    """The markers of hot users (rows ``t`` are theirs), by lookups in bounded pieces."""
    gap_rows = t.where("cut").select(
        *USER, (F.col("seg") - 1).alias("seg"), (F.col("ts") - F.col("gap") + d).alias("ts"),
        (F.col("idx") - 1).alias("rank"))
    local_rank = _hot_local_ranks(t, gap_rows, hot, block_rows)
    gaps = gap_rows.join(local_rank, USER + ["rank"], "inner").select(
        *USER, "seg", "ts", (F.col("local_ts") + d).alias("local_ts"), F.lit("gap").alias("kind"))
    tail = t.groupBy(*USER).agg(F.max("seg").alias("seg"), (F.max("ts") + d).alias("ts"),
                                (F.max("local_ts") + d).alias("local_ts"))
    tail = tail.where(F.to_date(ntz_from_seconds("local_ts")) <= F.lit(end_date).cast("date")) \
               .select(*USER, "seg", "ts", "local_ts", F.lit("tail").alias("kind"))
    seg_len = t.groupBy(*USER, "seg").agg(F.count(F.lit(1)).alias("n"))
    return (gaps.unionByName(tail).join(seg_len, USER + ["seg"], "inner")
            .select(*USER, "seg", (F.col("n") + 1).alias("pos"), "ts", "local_ts", "kind"))


def chain_elements(t: DataFrame, max_gap: float | None, end_date, hot_user_rows: int | None = HOT_USER_ROWS,
                   block_rows: int = BLOCK_ROWS, hot=AUTO) -> DataFrame:
    """Visits and churn markers of touches ``t`` in one frame.

    Columns: CounterID, UserID, seg, pos, VisitID, SourceCode, ts, local_ts, EventType, Duration,
    Conversions, Revenue, idx (the visit's row number in its user, 0 for markers) and marker ('gap',
    'tail' or NULL). Gap markers: one per cut, at (time of the visit before the cut) + int(D); trailing
    markers: one per user at max(UTC) + int(D) and max(local) + int(D), kept when that local date is
    within the period. A marker closes its segment's chain: its pos is the segment's length + 1.
    Without a threshold there are no markers.
    """
    if max_gap is None:
        t = t.withColumn("_kind", F.lit("visit"))
        return t.select(*_element_columns(F.col("_kind"), "seg", "pos", "ts", "local_ts"))
    d = int(max_gap)
    hot = resolve_hot(t, USER, hot_user_rows, hot)
    if hot is None:
        return _timeline(t, d, end_date)
    # the markers read the touches several times over: stored, they are computed once
    t = checkpointed(t.select(*USER, "idx", "seg", "pos", "VisitID", "StartDate", "SourceCode", "ts", "local_ts", "gap",
                              "cut", "Duration", "Conversions", "Revenue"), "hot-chain-touches")
    hot_t = t.join(hot, USER, "left_semi")
    marks = _hot_markers(hot_t, d, end_date, hot, block_rows).select(
        *USER, "seg", "pos", "ts", "local_ts", F.col("kind").alias("_kind"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in (
            ("VisitID", "long"), ("SourceCode", "string"), ("Duration", "long"), ("Conversions", "long"),
            ("Revenue", "double"), ("idx", "long"))])
    visits = hot_t.select(*[F.col(c) for c in marks.columns if c != "_kind"], F.lit("visit").alias("_kind"))
    both = visits.unionByName(marks)
    both = both.select(*_element_columns(F.col("_kind"), "seg", "pos", "ts", "local_ts"))
    return _timeline(t.join(hot, USER, "left_anti"), d, end_date).unionByName(both)


def churn_markers(t: DataFrame, max_gap: float | None, end_date,
                  hot_user_rows: int | None = HOT_USER_ROWS, block_rows: int = BLOCK_ROWS,
                  hot=AUTO) -> DataFrame:
    """The marker rows alone: CounterID, UserID, seg, ts, local_ts, kind ('gap' / 'tail'), pos."""
    el = chain_elements(t, max_gap, end_date, hot_user_rows, block_rows, hot)
    return el.where(F.col("marker").isNotNull()).select(
        *USER, "seg", "ts", "local_ts", F.col("marker").alias("kind"), "pos")


def _hot_local_ranks(t: DataFrame, gap_rows: DataFrame, hot: DataFrame, block_rows: int) -> DataFrame:
    """(user, rank, local_ts) of the rank-th smallest local time, for the ranks the hot users' cuts need.

    Per (user, local second) the visits are counted; the second covers the
    ranks (earlier + 1 .. earlier + count), and the rank-th smallest time is
    the second whose range starts at or before the rank -- an as-of lookup
    on the rank axis (``rows_before`` gives the ranges in bounded windows).
    """
    per_sec = t.join(hot, USER, "left_semi").groupBy(*USER, "local_ts").agg(F.count(F.lit(1)).alias("_c"))
    points = rows_before(per_sec, USER, "local_ts").select(
        *USER, (F.col("_before") + 1).alias("pos"), F.col("local_ts").alias("value"))
    queries = gap_rows.join(hot, USER, "left_semi").select(*USER, F.col("rank").alias("pos")).distinct()
    return asof_last(points, queries, USER, block_rows).select(
        *USER, F.col("value").alias("local_ts"), F.col("pos").alias("rank"))


def visits_ahead(elements: DataFrame, max_gap: float | None,
                 hot_user_rows: int | None = HOT_USER_ROWS, block_rows: int = BLOCK_ROWS,
                 hot=AUTO) -> DataFrame:
    """Add VisitsSum and VisitsSumAfterDuration to chain elements.

    VisitsSum: the user's visits with time in (t, t + int(D)].
    VisitsSumAfterDuration: visits with time in [t + e, t + int(D)], e = max(Duration, 1).

    With F(x) = visits at or before x (a growing range frame, linear),
    VisitsSum = F(t + int(D)) - F(t). The second lower bound differs per row,
    so G(t + e) (visits strictly before t + e) comes from probe rows in the same
    per-user order; the result is F(t + int(D)) - G(t + e), floored at 0.
    ``elements`` come from ``chain_elements`` (``idx`` tells a user's visits apart).
    """
    d = int(max_gap) if max_gap is not None else 0
    hot = resolve_hot(elements, USER, hot_user_rows, hot)
    if hot is not None:
        elements = checkpointed(elements, "hot-elements")       # read several times over
        normal = _visits_ahead_plain(elements.join(hot, USER, "left_anti"), d)
        return normal.unionByName(_visits_ahead_hot(elements.join(hot, USER, "left_semi"), d))
    return _visits_ahead_plain(elements, d)


_AHEAD_BUCKET_SECONDS = 3600


def _visits_ahead_hot(elements: DataFrame, d: int) -> DataFrame:
    """Visits ahead for hot users without a per-user task.

    F(x) = visits at or before second x comes from an as-of lookup into the
    per-second running count (one row per second with visits); every element
    asks for F(t), F(t + int(D)) and F(t + e - 1) (= visits strictly before
    t + e), answers are joined back on the element's own key.
    """
    visits = elements.where(F.col("EventType") == VISIT)
    per_sec = visits.groupBy(*USER, "ts").agg(F.count(F.lit(1)).alias("_c"))
    cum = rows_before(per_sec, USER, "ts").select(
        *USER, F.col("ts").alias("pos"), (F.col("_before") + F.col("_c")).alias("value"))
    ekey = USER + ["idx", "EventType", "ts"]     # idx tells visits apart, the time markers
    e_lo = F.col("ts") + F.greatest(F.col("Duration"), F.lit(1)) - 1
    asks = elements.select(*ekey, F.explode(F.array(
        F.struct(F.lit("at").alias("q"), F.col("ts").alias("x")),
        F.struct(F.lit("end").alias("q"), (F.col("ts") + d).alias("x")),
        F.struct(F.lit("lo").alias("q"), e_lo.alias("x")))).alias("a")).select(*ekey, "a.q", "a.x")
    found = asof_last(cum, asks.select(*USER, F.col("x").alias("pos")).distinct(), USER,
                      _AHEAD_BUCKET_SECONDS)
    answers = (asks.join(found.withColumnRenamed("pos", "x"), USER + ["x"], "left")
               .groupBy(*ekey).agg(*[F.max(F.when(F.col("q") == q, F.coalesce(F.col("value"), F.lit(0))))
                                     .alias(f"f_{q}") for q in ("at", "end", "lo")]))
    out = elements.join(answers, ekey, "inner")
    ahead = F.col("f_end") - F.col("f_at")
    after = F.when(F.col("EventType") == VISIT, F.greatest(F.col("f_end") - F.col("f_lo"), F.lit(0))) \
             .otherwise(ahead)
    return out.select(*elements.columns, ahead.cast("long").alias("VisitsSum"),
                      after.cast("long").alias("VisitsSumAfterDuration"))


def _visits_ahead_plain(elements: DataFrame, d: int) -> DataFrame:
    """Visits ahead of ordinary users, in user windows without a join.

    Every visit also emits a probe at t + e. On one time order F(t), F(t + d) (visits at or before) and,
    for a probe, G(t + e) (visits strictly before its time) are three growing frames; a second window over
    the visit's own rows hands the probe's count to the visit.
    """
    visit = F.col("EventType") == VISIT
    here = F.struct(F.col("ts").alias("at"), F.lit(False).alias("probe"))
    probe = F.struct((F.col("ts") + F.greatest(F.col("Duration"), F.lit(1))).alias("at"), F.lit(True).alias("probe"))
    points = elements.select("*", F.explode(F.when(visit, F.array(here, probe)).otherwise(F.array(here))).alias("_p"))
    points = points.select("*", F.col("_p.at").alias("_at"), F.col("_p.probe").alias("_probe"),
                           ((F.col("EventType") == VISIT) & ~F.col("_p.probe")).cast("long").alias("_one"))
    by_time = Window.partitionBy(*USER).orderBy("_at")
    upto = lambda hi: F.coalesce(
        F.sum("_one").over(by_time.rangeBetween(Window.unboundedPreceding, hi)), F.lit(0))
    points = points.select("*", upto(0).alias("_f"), upto(d).alias("_f_end"), upto(-1).alias("_before"))
    same = Window.partitionBy(*USER, "idx", "EventType")
    points = points.select("*", F.max(F.when(F.col("_probe"), F.col("_before"))).over(same).alias("_g"))
    ahead = F.col("_f_end") - F.col("_f")
    after = F.when(visit, F.greatest(F.col("_f_end") - F.col("_g"), F.lit(0))).otherwise(ahead)
    return points.where(~F.col("_probe")).select(*elements.columns, ahead.cast("long").alias("VisitsSum"),
                                                 after.cast("long").alias("VisitsSumAfterDuration"))


def chains(t: DataFrame, max_gap: float | None, end_date,
           hot_user_rows: int | None = HOT_USER_ROWS, block_rows: int = BLOCK_ROWS,
           hot=AUTO) -> DataFrame:
    """The chain table, one row per chain element (visits and markers).

    Columns: StartDate (local date of the element), UserID, CounterID, chain,
    pos, VisitID (0 for markers), SourceCode ('null' for markers), StartTime,
    UTCStartTime, EventType, Duration, VisitsSum, VisitsSumAfterDuration,
    Conversions, Revenue. A row's chain is its (CounterID, UserID, chain)
    rows with pos <= its pos; reports use only chains that end in a visit.
    """
    hot = resolve_hot(t, USER, hot_user_rows, hot)
    el = chain_elements(t, max_gap, end_date, hot_user_rows, block_rows, hot=hot)
    el = visits_ahead(el, max_gap, hot_user_rows, block_rows, hot=hot)
    return el.select(
        F.to_date(ntz_from_seconds("local_ts")).alias("StartDate"), "UserID", "CounterID",
        F.col("seg").alias("chain"), F.col("pos").cast("long").alias("pos"), "VisitID", "SourceCode",
        ntz_from_seconds("local_ts").alias("StartTime"), ntz_from_seconds("ts").alias("UTCStartTime"),
        "EventType", F.col("Duration").cast("long").alias("Duration"),
        F.col("VisitsSum").cast("long"), F.col("VisitsSumAfterDuration").cast("long"),
        F.col("Conversions").cast("long"), F.col("Revenue").cast("double"))


def history_of(chain_table: DataFrame, counter_id: int, user_id: int, chain: int, pos: int) -> DataFrame:
    """The elements of one chain in order: what the original table kept as the row's history arrays."""
    return (chain_table.where((F.col("CounterID") == counter_id) & (F.col("UserID") == user_id)
                              & (F.col("chain") == chain) & (F.col("pos") <= pos))
            .orderBy("pos"))
