"""DuckDB SQL of the queries that SQL can express on whole tables, written from the rules, not from the plans."""

from __future__ import annotations

from touchline.llm.op2_quality_rules import MIN_WORDS, RULES, STOP_WORDS

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rules_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    passed = []
    for rule in RULES:
        over, under = rule.ratio.split(" / ")
        ratio = f"(CASE WHEN {under} = 0 THEN 0.0 ELSE CAST({over} AS DOUBLE) / {under} END)"
        tests = [f"{ratio} >= {rule.low}"] * (rule.low is not None) + [f"{ratio} <= {rule.high}"] * (rule.high is not None)
        passed.append((rule.name, " AND ".join(tests)))
    failed = ", ".join(f"CASE WHEN NOT ({test}) THEN '{name}' END" for name, test in passed)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
often AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often WHERE n > 1)
  GROUP BY doc_id
),
counts AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(w, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words,
    CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_shouts
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND {" AND ".join(f"({t})" for _, t in passed)} AS kept,
  concat_ws(',', {failed}) AS failed_rules
FROM counts"""


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
),
keyed AS (SELECT *, translate(trim(line, {SPACES}), '{UPPER}', '{LOWER}') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
judged AS (
  SELECT k.*, s.holder IS NOT NULL AND s.holder <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON s.key = k.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
shown AS (
  SELECT *, '<|im_start|>' || replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>') || chr(10)
    || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) AS rendered
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, rendered)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, rendered) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(rendered)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""

def _jaccard_sql(size: int) -> str:
    """Documents, the sizes of their sets of shingles, and the smallest doc_id they are linked with."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size}
    THEN list_transform(range(1, len(w) - {size - 2}), lambda i: md5(array_to_string(w[i:i + {size - 1}], ' ')))
    WHEN len(w) > 0 THEN [md5('short ' || array_to_string(w, ' '))] ELSE [] END) AS s
  FROM d
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS start, doc_id AS node FROM d
  UNION
  SELECT start, b FROM reach JOIN both_ways ON a = node
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
JOIN (SELECT start, min(node) AS component_id FROM reach GROUP BY start) ON start = d.doc_id"""


TRIE_SQL = """
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
sizes AS (SELECT c, max(pos) AS n FROM own GROUP BY c),
-- CRC-32: one step a byte, eight shifts a step
hashed AS (
  SELECT c, n, c - c % 5 AS base, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM sizes
),
convs AS (
  SELECT x.c, x.base, x.h, least(x.h, coalesce(b.n, 0)) AS m FROM hashed x LEFT JOIN sizes b ON b.c = x.base
),
rebuilt AS (
  SELECT v.c, o.pos AS d, role, text FROM convs v JOIN own o ON o.c = v.base AND o.pos <= v.m
  UNION ALL
  SELECT v.c, v.m + o.pos - v.h, role, text FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h
),
ways AS (
  SELECT c, d, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
    OVER (PARTITION BY c ORDER BY d)) AS node, strlen(text) AS bytes
  FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM convs
),
steps AS (
  SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS up, max(d) OVER (PARTITION BY c) AS last FROM ways
),
nodes AS (
  SELECT node, any_value(up) AS up, any_value(d) AS d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = last), '')) AS ends_sha256
  FROM steps GROUP BY node
),
children AS (SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
full_nodes AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.node = nodes.node),
totals AS (
  SELECT w.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved
  FROM full_nodes v JOIN ways w ON w.c = v.conv_id AND w.d <= v.d GROUP BY w.node
)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN totals t ON t.node = f.node LEFT JOIN nodes p ON p.node = f.up"""


SUBSTRINGS_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
places AS (
  SELECT doc_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS i,
    unnest(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i + 34 <= len(w) THEN md5(array_to_string(w[i:i + 34], ' ')) END)) AS win,
    unnest(w) AS word
  FROM d
),
counted AS (SELECT *, CASE WHEN win IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY win) END AS often FROM places),
judged AS (
  SELECT *, max(often) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 1 AS gone FROM counted
),
kept AS (
  SELECT doc_id, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

ORACLE_SQL = {"op2_quality_rules": _rules_sql(), "op6_chat": CHAT_SQL, "op8_line_dedup": LINES_SQL,
              "op5_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({_jaccard_sql(2)})",
              "op11_ngram_join": _jaccard_sql(5), "op13_prefix_trie": TRIE_SQL, "op9_substrings": SUBSTRINGS_SQL}
