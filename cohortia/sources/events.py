"""Adapter from the generic ``events`` table to the two product event tables.

The test data has one ``events`` table (event_id, ts, user_id, event_type,
value, props).  It is mapped, row for row, to

* ``feed_actions``    – view and click rows (click = like), post_id = props.k
* ``message_actions`` – purchase and signup rows, reciever_id = props.k

and user attributes are derived from ``user_id`` so that every dimension the
operators slice by exists.  The mapping is a pure projection + filter, so the
whole adapter is folded into the scan by Catalyst: only the columns a query
uses are read and the event_type filter is pushed into parquet.

The same expressions are repeated as a SQL CTE in ``cohortia.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.sources.tables import read_parquet

# Lookup lists for the derived geography of the test adapter
# (country by user_id % 7, city by user_id % 11).  The oracle CTE uses the same.
COUNTRIES = ["Russia", "Ukraine", "Belarus", "Kazakhstan", "Azerbaijan", "Finland", "Turkey"]
CITIES = ["Moscow", "Saint Petersburg", "Novosibirsk", "Yekaterinburg", "Kazan", "Minsk",
          "Kyiv", "Almaty", "Baku", "Helsinki", "Istanbul"]

FEED_TYPES = ("view", "click")
MESSAGE_TYPES = ("purchase", "signup")


def _sql_array(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


# Derived user attributes, each one SQL expression (parsed once on the JVM side).
_DIM_EXPRS = [
    "CAST(user_id % 2 AS INT) AS gender",
    "CAST(18 + user_id % 50 AS INT) AS age",
    "CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os",
    "CASE WHEN user_id % 5 < 2 THEN 'ads' ELSE 'organic' END AS source",
    f"element_at({_sql_array(COUNTRIES)}, CAST(user_id % 7 + 1 AS INT)) AS country",
    f"element_at({_sql_array(CITIES)}, CAST(user_id % 11 + 1 AS INT)) AS city",
    "CAST(user_id % 4 AS INT) AS exp_group",
]


def _user_dims(uid: Column | None = None) -> list[Column]:
    return [F.expr(e) for e in _DIM_EXPRS]


def feed_actions(events: DataFrame) -> DataFrame:
    """events → feed_actions(user_id, post_id, action, time, gender, age, os, source,
    country, city, exp_group)."""
    return (events.where(F.col("event_type").isin(*FEED_TYPES))
            .select(F.col("user_id"),
                    F.expr("TRY_CAST(get_json_object(props, '$.k') AS BIGINT) AS post_id"),
                    F.expr("CASE WHEN event_type = 'view' THEN 'view' ELSE 'like' END AS action"),
                    F.expr("CAST(ts AS TIMESTAMP) AS time"),
                    *_user_dims()))


def message_actions(events: DataFrame) -> DataFrame:
    """events → message_actions(user_id, reciever_id, time, gender, age, os, source,
    country, city, exp_group).  Attributes are those of the sender."""
    return (events.where(F.col("event_type").isin(*MESSAGE_TYPES))
            .select(F.col("user_id"),
                    F.expr("TRY_CAST(get_json_object(props, '$.k') AS BIGINT) AS reciever_id"),
                    F.expr("CAST(ts AS TIMESTAMP) AS time"),
                    *_user_dims()))


def load_events(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(feed_actions, message_actions) from ``{base}/events.parquet``."""
    ev = read_parquet(spark, base, "events")
    return feed_actions(ev), message_actions(ev)


def orders_activity(spark: SparkSession, base: str) -> DataFrame:
    """``orders`` as a second, long activity table: (user_id, time).

    Seven years of order dates give the weekly lifecycle and cohort operators a
    table with many weeks and cohorts.
    """
    o = read_parquet(spark, base, "orders")
    return o.select(F.col("o_custkey").alias("user_id"),
                    F.col("o_orderdate").cast("timestamp").alias("time"))
