"""Independent SQL (DuckDB dialect) for the registered queries.

Every oracle starts from the raw ``events`` view and repeats the adapter of
``cohortia.sources.events`` as CTEs, so the SQL and the Spark code share no
intermediate result.  Float outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from cohortia.sources.events import CITIES, COUNTRIES


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_DIMS = f"""
    CAST(user_id % 2 AS INTEGER) AS gender,
    CAST(18 + user_id % 50 AS INTEGER) AS age,
    CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
    CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source,
    {_sql_list(COUNTRIES)}[CAST(user_id % 7 AS INTEGER) + 1] AS country,
    {_sql_list(CITIES)}[CAST(user_id % 11 AS INTEGER) + 1] AS city,
    CAST(user_id % 4 AS INTEGER) AS exp_group"""

ADAPTER_CTES = f"""
feed_actions AS (
  SELECT user_id,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS post_id,
    CASE WHEN event_type = 'view' THEN 'view' ELSE 'like' END AS action,
    CAST(ts AS TIMESTAMP) AS time,{_DIMS}
  FROM events WHERE event_type IN ('view', 'click')),
message_actions AS (
  SELECT user_id,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS reciever_id,
    CAST(ts AS TIMESTAMP) AS time,{_DIMS}
  FROM events WHERE event_type IN ('purchase', 'signup')),
orders_activity AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS TIMESTAMP) AS time FROM orders)"""


def build(body: str, doubles: tuple[str, ...] = ()) -> str:
    """Prefix the adapter CTEs and round the float columns of ``body``."""
    if doubles:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        return f"WITH {ADAPTER_CTES}\nSELECT * REPLACE ({rep}) FROM (\n{body}\n) q"
    return f"WITH {ADAPTER_CTES}\nSELECT * FROM (\n{body}\n) q"
