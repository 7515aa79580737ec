"""DuckDB SQL of the queries of loaders, sinks and stored states, written from the rules."""

from __future__ import annotations

from touchline.plans import oracle as base
from touchline.plans.registry_stored import PERIODS

LABELS_SQL = r"""
SELECT event_id, CASE event_id % 7
  WHEN 0 THEN NULL
  WHEN 1 THEN '"' || event_type || chr(9) || 'said "x"' || chr(10)
  WHEN 2 THEN event_type || '\t\N\\'
  WHEN 3 THEN '\N'
  WHEN 4 THEN ''
  ELSE '  ' || event_type || ' ''é''' || chr(13) END AS label
FROM events"""


def _hashed(column: str) -> str:
    """CTEs that end in ``hashed``: every user with the 32-bit hash of its id (64-bit sums wrap)."""
    full = "18446744073709551616::HUGEINT"

    def right(x: str, k: int) -> str:
        return f"(({x} >> {k}) | (({x} << {64 - k}) % {full}))"

    def xor(x: str, k: int) -> str:
        return f"xor(CAST({x} AS UBIGINT), CAST({right(x, k)} AS UBIGINT))::HUGEINT"

    return f"""
h0 AS (SELECT DISTINCT {column}, ({column}::HUGEINT + {full}) % {full} AS k FROM vsrc),
h1 AS (SELECT {column}, ((18446744073709551615::HUGEINT - k) + k * 262144 % {full}) % {full} AS k FROM h0),
h2 AS (SELECT {column}, {xor('k', 31)} AS k FROM h1),
h3 AS (SELECT {column}, k * 21 % {full} AS k FROM h2),
h4 AS (SELECT {column}, {xor('k', 11)} AS k FROM h3),
h5 AS (SELECT {column}, (k + k * 64 % {full}) % {full} AS k FROM h4),
hashed AS (SELECT {column}, {xor('k', 22)} % 4294967296 AS hash FROM h5)"""


def _quantile(where: str) -> str:
    return f"""(SELECT round(quantile_cont(gap, 0.95), 6) FROM (
    SELECT ts - lag(ts) OVER (PARTITION BY UserID ORDER BY ts) AS gap FROM vsrc WHERE {where}) WHERE gap IS NOT NULL)"""


def oracle_sql() -> dict[str, str]:
    done = base.oracle_sql()
    periods = " UNION ALL ".join(
        f"SELECT '{a}' AS start_date, '{b}' AS end_date, {_quantile(f'StartDate BETWEEN DATE {chr(39)}{a}{chr(39)} AND DATE {chr(39)}{b}{chr(39)}')} AS max_gap"
        for a, b in PERIODS)
    half = base._with(base.visits_cte(), _hashed("UserID"),
                      base._threshold_cte().replace("FROM vsrc", "FROM vsrc JOIN hashed USING (UserID) WHERE hash < 2147483648"))
    return {
        "visits_published": done["latest_live_visits"],
        "visits_replaced": done["latest_live_visits"],
        "chains_published": done["chains_array"],
        "visits_json_lines": done["raw_visits_flat"],
        "visits_json_document": done["raw_visits_flat"],
        "labels_tsv": LABELS_SQL,
        "touches_stored_layout": done["touches_segments"],
        "chains_refreshed": done["chains_array"],
        "gap_quantile_hash_range": f"{half}\nSELECT round(d, 6) AS max_gap, di AS max_gap_seconds FROM thr",
        "user_buckets": f"""{base._with(base.visits_cte(), _hashed("UserID"))}
SELECT CAST(hash * 8 // 4294967296 AS BIGINT) AS bucket, count(*) AS visits, count(DISTINCT UserID) AS users
FROM vsrc JOIN hashed USING (UserID) GROUP BY 1""",
        "gap_quantile_of_state": f"{base._with(base.visits_cte())} {periods}",
        "source_users_sketched": f"""{base._with(base.visits_cte())}
SELECT SourceCode, count(DISTINCT (CounterID, UserID)) AS users, true AS close FROM vsrc GROUP BY SourceCode""",
    }
