"""Reference SQL (DuckDB dialect) for every registered query.

The SQL follows the array form of the original pipeline: each chain is a
list of the sources of its segment up to its visit, and reports read
``chain[-1]``, ``chain[1]``, ``list_filter(...)``, ``unnest(chain)``,
``list_distinct(chain)``, ``list_slice(chain, 2, len - 1)`` and scalar
subquery denominators. The Spark plans instead work on one row per touch
with running and suffix windows, so agreement checks those identities.

Tables: the driver's ``events`` view. Times are epoch seconds throughout.
"""

from __future__ import annotations

from touchline.operators.positions import POSITION_PARTS, displayed_columns
from touchline.plans.fixture import fixture_name_rows
from touchline.plans.registry import END, START
from touchline.sources.names import UNKNOWN_SOURCE_NAME

GOALS_PURCHASES = "purchases"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _day(expr: str) -> str:
    return f"strftime(make_timestamp(CAST({expr} AS BIGINT) * 1000000), '%Y-%m-%d')"


RAW = """
ev AS (
  SELECT event_id, user_id, event_type,
         CAST(regexp_extract(props, '"k":\\s*(-?\\d+)', 1) AS INTEGER) AS k,
         1 + event_id % 3 AS nv,
         CAST(floor(epoch(ts)) AS BIGINT) AS t0,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events
),
ev_real AS (
  SELECT *,
    {'Model': 1, 'StartTime': t0 + 10800,
     'ID': [0,1,2,2,3,3,3,3,8,9,10,-1,4,5,7,11][1 + (event_id * 7 + k) % 16],
     'SearchEngineID': 1 + k % 5, 'AdvEngineID': [1,1,1,2,12,17,37][1 + k % 7],
     'SocialSourceNetworkID': 1 + k % 6,
     'ClickBannerID': CASE WHEN k % 2 = 0 THEN 1000 + k ELSE 0 END,
     'ClickTargetType': [0,2,3][1 + k % 3], 'RecommendationSystemID': 2 + k % 3,
     'MessengerID': 1 + k % 5} AS m_real,
    {'Model': 2, 'StartTime': t0 - 86400, 'ID': 1, 'SearchEngineID': 9, 'AdvEngineID': 3,
     'SocialSourceNetworkID': 0, 'ClickBannerID': 0, 'ClickTargetType': 9,
     'RecommendationSystemID': 0, 'MessengerID': 0} AS m_decoy,
    CASE WHEN k = 1 THEN -5000000 WHEN k = 2 THEN 200000000000 ELSE cents * 10000 END AS rev1
  FROM ev
),
ev_versions AS (
  SELECT *, unnest(range(1, nv + 1)) AS ver FROM ev_real
),
raw AS (
  SELECT
    CAST(CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS CounterID,
    user_id AS UserIDHash, event_id + 1 AS VisitID, ver AS VisitVersion,
    unnest(CASE WHEN ver < nv OR event_id % 23 = 0 THEN [1, -1] ELSE [1] END) AS Sign,
    CAST(make_timestamp(t0 * 1000000) AS DATE) AS StartDate,
    t0 AS UTCStartTime,
    CASE WHEN event_id % 97 = 0 THEN 200000 ELSE (k * 13) % 1800 + (nv - ver) END AS Duration,
    CASE WHEN event_id % 31 = 0 THEN [m_decoy]
         WHEN event_id % 2 = 0 THEN [m_real, m_decoy]
         ELSE [m_decoy, m_real] END AS TrafficSource,
    CASE WHEN event_type = 'purchase' AND k % 7 = 0
           THEN [{'ID': 'p' || event_id, 'Revenue': rev1}, {'ID': 'q' || event_id, 'Revenue': 1500000}]
         WHEN event_type = 'purchase' THEN [{'ID': 'p' || event_id, 'Revenue': rev1}]
         ELSE [] END AS EPurchase,
    CASE WHEN event_type = 'signup' THEN [{'ID': 10, 'Price': cents * 10}]
         WHEN event_type = 'click' THEN [{'ID': 20, 'Price': cents * 10}, {'ID': 20, 'Price': cents * 10}]
         WHEN event_type = 'purchase' THEN [{'ID': 10, 'Price': cents * 10}, {'ID': 30, 'Price': cents * 10}]
         ELSE [] END AS Goals
  FROM ev_versions
)"""


def _conv_rev(goals) -> tuple[str, str]:
    if goals == []:
        return "1", "0.0"
    if goals == [-1]:
        conv = "len(EPurchase)"
        rev = ("round(coalesce(list_sum(list_transform(EPurchase, lambda p: "
               "CAST(CASE WHEN p.Revenue < 0 THEN 0 WHEN p.Revenue > 112170000000 THEN 0 "
               "ELSE p.Revenue END AS DOUBLE) / 1000000)), 0.0), 2)")
        return conv, rev
    ids = ", ".join(str(int(g)) for g in goals)
    conv = f"len(list_filter(Goals, lambda g: g.ID IN ({ids})))"
    rev = (f"round(CAST(coalesce(list_sum(list_transform(list_filter(Goals, lambda g: g.ID IN ({ids})), "
           f"lambda g: g.Price)), 0) AS DOUBLE) / 1000, 2)")
    return conv, rev


# visit ids that start again at 1 on every date of a user
REPEATED_IDS = """repeated AS (
  SELECT * REPLACE (dense_rank() OVER (PARTITION BY CounterID, UserIDHash, StartDate ORDER BY VisitID) AS VisitID)
  FROM raw
)"""


def visits_cte(goals=(-1,), repeated_ids: bool = False) -> str:
    conv, rev = _conv_rev(list(goals))
    source = "repeated" if repeated_ids else "raw"
    return f"""{RAW},
{REPEATED_IDS + "," if repeated_ids else ""}
rv AS (
  SELECT CounterID, UserIDHash AS UserID, VisitID, StartDate, VisitVersion, Sign, UTCStartTime, Duration,
         list_filter(TrafficSource, lambda t: t.Model = 1)[1] AS m1,
         {conv} AS conv, {rev} AS rev
  FROM {source}
  WHERE StartDate >= DATE '{START}' AND StartDate <= DATE '{END}'
),
vis AS (
  SELECT CounterID, UserID, VisitID, StartDate,
    arg_max(UTCStartTime, VisitVersion) AS UTCStartTime,
    arg_max(coalesce(m1.StartTime, 0), VisitVersion) AS StartTime,
    arg_max(Duration, VisitVersion) AS Duration,
    arg_max(coalesce(m1.ID, 0), VisitVersion) AS TraficSourceID,
    arg_max(coalesce(m1.SearchEngineID, 0), VisitVersion) AS SearchEngineID,
    arg_max(coalesce(m1.AdvEngineID, 0), VisitVersion) AS AdvEngineID,
    arg_max(coalesce(m1.SocialSourceNetworkID, 0), VisitVersion) AS SocialSourceNetworkID,
    arg_max(coalesce(m1.ClickBannerID, 0), VisitVersion) AS ClickBannerID,
    arg_max(coalesce(m1.ClickTargetType, 0), VisitVersion) AS ClickTargetType,
    arg_max(coalesce(m1.RecommendationSystemID, 0), VisitVersion) AS RecommendationSystemID,
    arg_max(coalesce(m1.MessengerID, 0), VisitVersion) AS MessengerID,
    arg_max(conv, VisitVersion) AS Conversions,
    arg_max(rev, VisitVersion) AS Revenue
  FROM rv
  GROUP BY CounterID, UserID, VisitID, StartDate
  HAVING sum(Sign) > 0
),
vsrc AS (
  SELECT *, UTCStartTime AS ts, StartTime AS local_ts,
    CAST(TraficSourceID AS VARCHAR) || CASE
      WHEN TraficSourceID = 2 THEN '_' || CAST(SearchEngineID AS VARCHAR)
      WHEN TraficSourceID = 3 AND AdvEngineID = 1 AND ClickBannerID <> 0
        THEN '_' || CAST(AdvEngineID AS VARCHAR) || '_' || CAST(ClickTargetType AS VARCHAR)
      WHEN TraficSourceID = 3 THEN '_' || CAST(AdvEngineID AS VARCHAR)
      WHEN TraficSourceID = 8 THEN '_' || CAST(SocialSourceNetworkID AS VARCHAR)
      WHEN TraficSourceID = 9 THEN '_' || CAST(RecommendationSystemID AS VARCHAR)
      WHEN TraficSourceID = 10 THEN '_' || CAST(MessengerID AS VARCHAR)
      ELSE '' END AS SourceCode
  FROM vis
)"""


def _threshold_cte(sampled: bool = False) -> str:
    where = "WHERE UserID % 10 = 0" if sampled else ""
    return f"""
ugaps AS (
  SELECT UserID, list_sort(list(ts)) AS times FROM vsrc {where} GROUP BY UserID HAVING count(*) > 1
),
gaps AS (
  SELECT times[i + 1] - times[i] AS gap FROM (SELECT times, unnest(range(1, len(times))) AS i FROM ugaps)
),
thr AS (SELECT quantile_cont(gap, 0.95) AS d, CAST(trunc(quantile_cont(gap, 0.95)) AS BIGINT) AS di FROM gaps)"""


CHAIN_CTE = """
useq AS (
  SELECT v.*,
    ts - lag(ts) OVER (PARTITION BY CounterID, UserID ORDER BY ts, VisitID) AS gap,
    row_number() OVER (PARTITION BY CounterID, UserID ORDER BY ts, VisitID) AS idx
  FROM vsrc v
),
segd AS (
  SELECT u.*, CAST(sum(CASE WHEN gap > (SELECT d FROM thr) THEN 1 ELSE 0 END)
         OVER (PARTITION BY CounterID, UserID ORDER BY ts, VisitID ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg
  FROM useq u
),
ch AS (
  SELECT s.*,
    list(SourceCode) OVER w AS chain,
    list(VisitID) OVER w AS vids,
    count(*) OVER (PARTITION BY CounterID, UserID, seg) AS seg_len
  FROM segd s
  WINDOW w AS (PARTITION BY CounterID, UserID, seg ORDER BY ts, VisitID ROWS UNBOUNDED PRECEDING)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip())


def _money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


SIG = "lambda x: x NOT IN ('0', '-1', '4', '5', '6')"
LAST_SIG = f"coalesce(list_filter(chain, {SIG})[-1], chain[-1])"
LAST_DIRECT = (f"coalesce(list_filter(chain, lambda x: x LIKE '3_1_%')[-1], "
               f"list_filter(chain, lambda x: x = '3_1')[-1], list_filter(chain, {SIG})[-1], chain[-1])")


def _base(sampled=False) -> str:
    return _with(visits_cte(), _threshold_cte(sampled), CHAIN_CTE)


def _attr(key: str, prefix: str) -> str:
    return f"""{_base()}
SELECT {key} AS SourceCode, count(*) AS {prefix}Visits, CAST(sum(Conversions) AS BIGINT) AS {prefix}Convs,
       {_money('Revenue')} AS {prefix}Revenue
FROM ch GROUP BY 1"""


LINEAR_PART = """
SELECT SourceCode, round(sum(1.0::DOUBLE / n), 6) AS LinearAttrVisits,
       round(sum(CAST(Conversions AS DOUBLE) / n), 6) AS LinearAttrConvs,
       round(sum(Revenue / n), 6) AS LinearAttrRevenue
FROM (SELECT unnest(chain) AS SourceCode, len(chain) AS n, Conversions, Revenue FROM ch)
GROUP BY 1"""

ASSOC_PART = f"""
SELECT SourceCode, count(*) AS AssociatedVisits, CAST(sum(Conversions) AS BIGINT) AS AssociatedConvs,
       {_money('Revenue')} AS AssociatedRevenue
FROM (SELECT unnest(list_distinct(chain)) AS SourceCode, Conversions, Revenue FROM ch)
GROUP BY 1"""


def _share(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END"


_CONV = "Conversions > 0"
POS_SQL = {
    "pos_weight": f"""
SELECT SourceCode,
  {_share('count(*)', 'SELECT sum(len(chain)) FROM ch')} AS in_chain_perc_total,
  {_share(f'count(*) FILTER (WHERE {_CONV})', f'SELECT coalesce(sum(len(chain)) FILTER (WHERE {_CONV}), 0) FROM ch')} AS in_conv_chains_perc_total
FROM (SELECT unnest(chain) AS SourceCode, Conversions FROM ch) GROUP BY 1""",
    "pos_unique_chains": f"""
SELECT SourceCode,
  {_share('count(DISTINCT (CounterID, UserID, vids))', 'SELECT count(*) FROM ch')} AS unique_chains_perc,
  {_share(f'count(DISTINCT (CounterID, UserID, vids)) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch')} AS unique_conv_chains_perc
FROM (SELECT unnest(chain) AS SourceCode, CounterID, UserID, vids, Conversions FROM ch) GROUP BY 1""",
    "pos_first_2plus": f"""
SELECT chain[1] AS SourceCode,
  {_share('count(*)', 'SELECT count(*) FROM ch WHERE len(chain) > 1')} AS first_touch_2plus,
  {_share(f'count(*) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch WHERE len(chain) > 1')} AS first_touch_conv_2plus
FROM ch WHERE len(chain) > 1 GROUP BY 1""",
    "pos_first_all": f"""
SELECT chain[1] AS SourceCode,
  {_share('count(*)', 'SELECT count(*) FROM ch')} AS first_touch_total,
  {_share(f'count(*) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch')} AS first_touch_conv_total
FROM ch GROUP BY 1""",
    "pos_middle": f"""
SELECT SourceCode,
  {_share('count(DISTINCT (CounterID, UserID, vids))', 'SELECT count(*) FROM ch WHERE len(chain) > 3')} AS mid_touch_3plus,
  {_share(f'count(DISTINCT (CounterID, UserID, vids)) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch WHERE len(chain) > 3')} AS mid_touch_conv_3plus
FROM (SELECT unnest(list_slice(chain, 2, len(chain) - 1)) AS SourceCode, CounterID, UserID, vids, Conversions
      FROM ch WHERE len(chain) > 3) GROUP BY 1""",
    "pos_last_2plus": f"""
SELECT chain[-1] AS SourceCode,
  {_share('count(*)', 'SELECT count(*) FROM ch WHERE len(chain) > 1')} AS last_touch_2plus,
  {_share(f'count(*) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch WHERE len(chain) > 1')} AS last_touch_conv_2plus
FROM ch WHERE len(chain) > 1 GROUP BY 1""",
    "pos_last_all": f"""
SELECT chain[-1] AS SourceCode,
  {_share('count(*)', 'SELECT count(*) FROM ch')} AS last_touch_total,
  {_share(f'count(*) FILTER (WHERE {_CONV})', f'SELECT count(*) FILTER (WHERE {_CONV}) FROM ch')} AS last_touch_conv_total
FROM ch GROUP BY 1""",
}


def _names_cte() -> str:
    rows = ", ".join(f"({_sql_str(c)}, {_sql_str(n)})" for c, n in fixture_name_rows())
    return f"names(SourceCode, SourceName) AS (VALUES {rows})"


def _attr_part(key: str, prefix: str) -> str:
    return f"""SELECT {key} AS SourceCode, count(*) AS {prefix}Visits,
  CAST(sum(Conversions) AS BIGINT) AS {prefix}Convs, {_money('Revenue')} AS {prefix}Revenue
FROM ch GROUP BY 1"""


def _named(select_cols: str, from_sql: str) -> str:
    return (f"SELECT {select_cols}, coalesce(n.SourceName, {_sql_str(UNKNOWN_SOURCE_NAME)}) AS SourceName "
            f"FROM ({from_sql}) r LEFT JOIN names n USING (SourceCode)")


def simple_sql() -> str:
    parts = {
        "lc": _attr_part("chain[-1]", "LastClick"),
        "fc": _attr_part("chain[1]", "FirstClick"),
        "lsc": _attr_part(LAST_SIG, "LastSignClick"),
        "lsd": _attr_part(LAST_DIRECT, "LastSignDirect"),
        "lin": LINEAR_PART,
    }
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in parts.items())
    cols = []
    for k, prefix in [("lc", "LastClick"), ("fc", "FirstClick"), ("lsc", "LastSignClick"),
                      ("lsd", "LastSignDirect")]:
        cols += [f"coalesce({k}.{prefix}Visits, 0) AS {prefix}Visits",
                 f"coalesce({k}.{prefix}Convs, 0) AS {prefix}Convs",
                 f"coalesce({k}.{prefix}Revenue, 0.0) AS {prefix}Revenue"]
    cols += [f"coalesce(lin.{c}, 0.0) AS {c}" for c in ("LinearAttrVisits", "LinearAttrConvs",
                                                         "LinearAttrRevenue")]
    merged = ("SELECT coalesce(lc.SourceCode, fc.SourceCode, lsc.SourceCode, lsd.SourceCode, lin.SourceCode) "
              f"AS SourceCode, {', '.join(cols)} FROM lc "
              "FULL JOIN fc USING (SourceCode) FULL JOIN lsc USING (SourceCode) "
              "FULL JOIN lsd USING (SourceCode) FULL JOIN lin USING (SourceCode)")
    names = [c.split(" AS ")[-1] for c in cols]
    return f"{_base()}, {ctes}, {_names_cte()}\n" + _named(
        "r.SourceCode, " + ", ".join(f"r.{c}" for c in names), merged)


def associated_sql() -> str:
    return f"{_base()}, a AS ({ASSOC_PART}), {_names_cte()}\n" + _named(
        "r.SourceCode, r.AssociatedVisits, r.AssociatedConvs, r.AssociatedRevenue", "SELECT * FROM a")


def positions_sql() -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in POS_SQL.items())
    keys = list(POS_SQL)
    cols = [name for part in keys for name, _, _ in POSITION_PARTS[part][1]]
    by_part = {name: part for part in keys for name, _, _ in POSITION_PARTS[part][1]}
    src = "coalesce(" + ", ".join(f"{k}.SourceCode" for k in keys) + ")"
    joins = f"FROM {keys[0]} " + " ".join(f"FULL JOIN {k} USING (SourceCode)" for k in keys[1:])
    merged = (f"SELECT {src} AS SourceCode, "
              + ", ".join(f"coalesce({by_part[c]}.{c}, 0.0) AS {c}" for c in cols) + " " + joins)
    return f"{_base()}, {ctes}, {_names_cte()}\n" + _named(
        "r.SourceCode, " + ", ".join(f"r.{c}" for c in cols), merged)


def _visits_out(goals) -> str:
    return f"""{_with(visits_cte(goals))}
SELECT CounterID, UserID, VisitID, strftime(StartDate, '%Y-%m-%d') AS StartDate,
  CAST(UTCStartTime AS BIGINT) AS UTCStartTime, CAST(StartTime AS BIGINT) AS StartTime,
  CAST(Duration AS BIGINT) AS Duration, CAST(TraficSourceID AS BIGINT) AS TraficSourceID,
  CAST(SearchEngineID AS BIGINT) AS SearchEngineID, CAST(AdvEngineID AS BIGINT) AS AdvEngineID,
  CAST(SocialSourceNetworkID AS BIGINT) AS SocialSourceNetworkID, CAST(ClickBannerID AS BIGINT) AS ClickBannerID,
  CAST(ClickTargetType AS BIGINT) AS ClickTargetType, CAST(RecommendationSystemID AS BIGINT) AS RecommendationSystemID,
  CAST(MessengerID AS BIGINT) AS MessengerID, CAST(Conversions AS BIGINT) AS Conversions,
  CAST(Revenue AS DOUBLE) AS Revenue
FROM vsrc"""


MARKERS_CTE = f"""
ranked AS (
  SELECT CounterID, UserID, ts, local_ts,
    row_number() OVER (PARTITION BY CounterID, UserID ORDER BY ts, VisitID) AS by_utc,
    row_number() OVER (PARTITION BY CounterID, UserID ORDER BY local_ts, VisitID) AS by_local,
    lead(ts) OVER (PARTITION BY CounterID, UserID ORDER BY ts, VisitID) AS following
  FROM vsrc
),
ends AS (
  SELECT *, row_number() OVER (PARTITION BY CounterID, UserID ORDER BY by_utc) - 1 AS seg
  FROM ranked WHERE following - ts > (SELECT d FROM thr)
),
all_markers AS (
  SELECT e.CounterID, e.UserID, CAST(e.seg AS BIGINT) AS seg, e.ts + (SELECT di FROM thr) AS ts,
    r.local_ts + (SELECT di FROM thr) AS local_ts, 'gap' AS kind
  FROM ends e JOIN ranked r ON r.CounterID = e.CounterID AND r.UserID = e.UserID AND r.by_local = e.by_utc
  UNION ALL
  SELECT l.CounterID, l.UserID, CAST(coalesce(n, 0) AS BIGINT), l.ts + (SELECT di FROM thr),
    l.local_ts + (SELECT di FROM thr), 'tail'
  FROM (SELECT CounterID, UserID, max(ts) AS ts, max(local_ts) AS local_ts FROM vsrc GROUP BY ALL) l
  LEFT JOIN (SELECT CounterID, UserID, count(*) AS n FROM ends GROUP BY ALL) c
    ON c.CounterID = l.CounterID AND c.UserID = l.UserID
  WHERE make_timestamp((l.local_ts + (SELECT di FROM thr)) * 1000000)::DATE <= DATE '{END}'
),
elements AS (
  SELECT CounterID, UserID, VisitID, SourceCode, ts, local_ts, '2_VISIT' AS EventType,
         CAST(Duration AS BIGINT) AS Duration, CAST(Conversions AS BIGINT) AS Conversions, CAST(Revenue AS DOUBLE) AS Revenue
  FROM vsrc
  UNION ALL
  SELECT CounterID, UserID, 0, 'null', ts, local_ts, '0_NULL', 0, 0, 0.0 FROM all_markers
),
el AS (
  SELECT e.*,
    CAST(coalesce(sum(CASE WHEN EventType = '0_NULL' THEN 1 ELSE 0 END) OVER (PARTITION BY CounterID, UserID
         ORDER BY ts, EventType, VisitID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chain_id,
    CAST(coalesce(sum(CASE WHEN EventType = '2_VISIT' THEN 1 ELSE 0 END) OVER (PARTITION BY CounterID, UserID
         ORDER BY ts RANGE BETWEEN 1 FOLLOWING AND (SELECT di FROM thr) FOLLOWING), 0) AS BIGINT) AS VisitsSum
  FROM elements e
),
after AS (
  SELECT e.CounterID, e.UserID, e.ts, e.EventType, e.VisitID,
    CAST(count(v.VisitID) AS BIGINT) AS VisitsSumAfterDuration
  FROM el e LEFT JOIN vsrc v
    ON v.CounterID = e.CounterID AND v.UserID = e.UserID
   AND v.ts >= e.ts + greatest(e.Duration, 1) AND v.ts <= e.ts + (SELECT di FROM thr)
  GROUP BY e.CounterID, e.UserID, e.ts, e.EventType, e.VisitID
),
el2 AS (
  SELECT el.*, a.VisitsSumAfterDuration FROM el
  JOIN after a USING (CounterID, UserID, ts, EventType, VisitID)
)"""


def chains_sql(repeated_ids: bool = False) -> str:
    # the history of each element as the original builds it (a list over the chain up to the
    # element); its length is the element's position in the chain
    w = "OVER (PARTITION BY CounterID, UserID, chain_id ORDER BY ts, EventType, VisitID ROWS UNBOUNDED PRECEDING)"
    return f"""{_with(visits_cte(repeated_ids=repeated_ids), _threshold_cte(), MARKERS_CTE)}
SELECT {_day('local_ts')} AS StartDate, UserID, CounterID, chain_id AS chain,
  CAST(len(list(VisitID) {w}) AS BIGINT) AS pos, VisitID, SourceCode, local_ts AS StartTime,
  ts AS UTCStartTime, EventType, Duration, VisitsSum, VisitsSumAfterDuration, Conversions, Revenue
FROM el2"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_visits_signed"] = f"""{_with(RAW)}
SELECT CAST(CounterID AS BIGINT) AS CounterID, UserIDHash, VisitID, CAST(VisitVersion AS BIGINT) AS VisitVersion,
  CAST(Sign AS BIGINT) AS Sign, strftime(StartDate, '%Y-%m-%d') AS StartDate, UTCStartTime,
  CAST(Duration AS BIGINT) AS Duration,
  array_to_string(list_transform(TrafficSource, lambda t: CAST(t.Model AS VARCHAR)), ',') AS models,
  array_to_string(list_transform(TrafficSource, lambda t: CAST(t.ID AS VARCHAR)), ',') AS source_ids,
  array_to_string(list_transform(TrafficSource, lambda t: CAST(t.StartTime AS VARCHAR)), ',') AS source_times,
  array_to_string(list_transform(EPurchase, lambda p: p.ID), ',') AS purchase_ids,
  array_to_string(list_transform(EPurchase, lambda p: CAST(p.Revenue AS VARCHAR)), ',') AS purchase_revenue,
  array_to_string(list_transform(Goals, lambda g: CAST(g.ID AS VARCHAR)), ',') AS goal_ids,
  array_to_string(list_transform(Goals, lambda g: CAST(g.Price AS VARCHAR)), ',') AS goal_prices
FROM raw"""
    q["latest_live_visits"] = _visits_out([-1])
    q["raw_visits_flat"] = f"SELECT * REPLACE (CAST(0 AS BIGINT) AS MessengerID) FROM ({_visits_out([-1])})"
    q["visits_null_groups"] = _visits_out([-1])
    q["visits_goals_each_visit"] = _visits_out([])
    q["visits_goals_list"] = _visits_out([10, 20])
    q["source_code_counts"] = f"""{_with(visits_cte())}
SELECT SourceCode, count(*) AS visits, CAST(sum(Conversions) AS BIGINT) AS conversions,
  count(DISTINCT (CounterID, UserID)) AS users
FROM vsrc GROUP BY SourceCode"""
    for name, sampled in (("gap_quantile", False), ("gap_quantile_sampled", True)):
        q[name] = f"""{_with(visits_cte(), _threshold_cte(sampled))}
SELECT round(d, 6) AS max_gap, di AS max_gap_seconds FROM thr"""
    q["touches_segments"] = f"""{_base()}
SELECT CounterID, UserID, VisitID, ts, coalesce(gap, 0) AS gap, seg, idx, CAST(len(chain) AS BIGINT) AS pos, seg_len, SourceCode,
  chain[1] AS FirstSource, {LAST_SIG} AS LastSignSource, {LAST_DIRECT} AS LastDirectSource
FROM ch"""
    q["churn_markers"] = f"""{_with(visits_cte(), _threshold_cte(), MARKERS_CTE)}
SELECT CounterID, UserID, seg, ts, local_ts, kind FROM all_markers"""
    q["visits_ahead"] = f"""{_with(visits_cte(), _threshold_cte(), MARKERS_CTE)}
SELECT CounterID, UserID, VisitID, EventType, ts, VisitsSum FROM el2"""
    q["visits_ahead_after_duration"] = f"""{_with(visits_cte(), _threshold_cte(), MARKERS_CTE)}
SELECT CounterID, UserID, VisitID, EventType, ts, Duration, VisitsSumAfterDuration FROM el2"""
    q["chains_array"] = q["chains_blocked"] = chains_sql()
    q["chains_repeated_ids"] = chains_sql(repeated_ids=True)
    q["gap_quantile_blocked"] = q["gap_quantile"]
    q["touches_blocked"] = q["touches_segments"]
    q["attr_last_click"] = _attr("chain[-1]", "LastClick")
    q["attr_first_click"] = _attr("chain[1]", "FirstClick")
    q["attr_last_significant"] = _attr(LAST_SIG, "LastSignClick")
    q["attr_last_direct"] = _attr(LAST_DIRECT, "LastSignDirect")
    q["attr_linear"] = _base() + LINEAR_PART
    q["attr_associated"] = _base() + ASSOC_PART
    q["simple_attributions"] = simple_sql()
    q["associated_conversions"] = associated_sql()
    for part, sql in POS_SQL.items():
        q[part] = _base() + sql
    q["source_in_chains_metrics"] = positions_sql()
    assoc = associated_sql()
    q["top_associated_report"] = f"""SELECT SourceName,
  format('{{:,}}', AssociatedVisits) AS AssociatedVisits, format('{{:,}}', AssociatedConvs) AS AssociatedConvs,
  regexp_replace(format('{{:,.2f}}', AssociatedRevenue), '(\\.\\d)0$', '\\1') AS AssociatedRevenue
FROM ({assoc}) r ORDER BY r.AssociatedConvs DESC, r.SourceCode ASC LIMIT 10"""
    pos = positions_sql()
    for name, converting in (("top_chains_report", False), ("top_conv_chains_report", True)):
        cols = displayed_columns(converting)
        shown = ", ".join(f"printf('%.2f%%', {c} * 100) AS {c}" for c in cols)
        q[name] = f"SELECT SourceName, {shown} FROM ({pos}) r ORDER BY r.{cols[1]} DESC, r.SourceCode ASC LIMIT 10"
    q["top_simple_report"] = f"SELECT * FROM ({simple_sql()}) ORDER BY LastClickRevenue DESC, SourceCode ASC LIMIT 10"
    return q
