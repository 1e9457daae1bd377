"""Shared DuckDB SQL fragments for the oracles (same derivations as corpusflow.sources.derived)."""

CHAT = """chat AS (
  SELECT event_id AS message_id,
         CASE WHEN value < 10 THEN NULL ELSE user_id END AS user_id,
         json_extract_string(props, '$.k') AS session_id,
         ts AS created_at, event_type AS model, value
  FROM events)"""

SETTINGS = """settings AS (
  SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_custkey END AS user_id,
         CAST(c_custkey AS VARCHAR) AS session_id, c_acctbal > 0 AS consent
  FROM customer)"""

SALES = """sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS product_id, p_retailprice AS price,
         l_quantity AS units, CAST(p_retailprice * l_quantity AS DECIMAL(18, 2)) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def period(ts: str, span: str) -> str:
    if span == "week":
        return f"(date_trunc('week', {ts} + INTERVAL 1 DAY) - INTERVAL 1 DAY)"
    return f"date_trunc('{span}', {ts})"


def period_any(ts: str, span_col: str) -> str:
    return (f"(CASE WHEN {span_col} = 'week' THEN date_trunc('week', {ts} + INTERVAL 1 DAY) - INTERVAL 1 DAY "
            f"WHEN {span_col} = 'month' THEN date_trunc('month', {ts}) ELSE date_trunc('day', {ts}) END)")


def facets_sql(src: str, spans=("day", "week", "month"), type_="message", field="createdAt", where="TRUE") -> str:
    """Four facets per span over ``src`` (columns created_at, user_id, session_id)."""
    span_list = ", ".join(f"'{s}'" for s in spans)
    head = f"strftime(p_at, '%Y-%m-%d') AS \"at\", span, '{field}' AS field, '{type_}' AS type"
    x = (f"(SELECT span, {period_any('created_at', 'span')} AS p_at, user_id, session_id "
         f"FROM {src}, (SELECT unnest([{span_list}]) AS span) s WHERE {where})")
    return f"""
SELECT {head}, 'userId' AS "distinct", count(DISTINCT user_id) AS "count" FROM {x} x WHERE user_id IS NOT NULL GROUP BY p_at, span
UNION ALL
SELECT {head}, 'sessionId', count(DISTINCT session_id) FROM {x} x WHERE session_id IS NOT NULL GROUP BY p_at, span
UNION ALL
SELECT {head}, 'userOrSessionId', count(DISTINCT coalesce(CAST(user_id AS VARCHAR), session_id))
       + max(CASE WHEN user_id IS NULL AND session_id IS NULL THEN 1 ELSE 0 END) FROM {x} x GROUP BY p_at, span
UNION ALL
SELECT {head}, '_id', count(*) FROM {x} x GROUP BY p_at, span"""


def dsum(x: str) -> str:
    """Exact sum of a money-like double (decimal accumulator), as double."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38, 6))) AS DOUBLE)"

QA = """qa AS (
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

PAIRS = """pairs AS (
  SELECT q.conv_id, q.question, a.response_j, a.response_k
  FROM (SELECT conv_id, arg_min(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY conv_id) q
  JOIN (SELECT conv_id, list(text ORDER BY turn)[1] AS response_j, list(text ORDER BY turn)[2] AS response_k
        FROM conversations WHERE role = 'assistant' GROUP BY conv_id HAVING count(*) >= 2) a USING (conv_id))"""


def lit(s: str) -> str:
    """Python string -> DuckDB string literal (newlines through chr(10))."""
    parts = s.replace("'", "''").split("\n")
    return "(" + " || chr(10) || ".join(f"'{p}'" for p in parts) + ")"


SP = "[\\t\\n\\x0B\\f\\r ]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


THREADS = """th AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS m
             FROM conversations GROUP BY conv_id)"""
