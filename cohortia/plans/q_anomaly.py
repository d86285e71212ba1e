"""Registered series and anomaly queries."""

from __future__ import annotations

import datetime as dt

from cohortia.operators import anomaly
from cohortia.plans.catalog import register
from cohortia.sources.events import load_events

AS_OF_TS = dt.datetime(2024, 1, 31, 0, 0, 0)
MIDDAY_TS = dt.datetime(2024, 1, 30, 12, 7, 30)
N, A = 6, 4.0


def _series_sql(as_of_ts: dt.datetime, horizon: int = 1) -> str:
    lo = f"CAST(CAST(TIMESTAMP '{as_of_ts}' AS DATE) - {horizon} AS TIMESTAMP)"
    hi = f"time_bucket(INTERVAL '15 minutes', TIMESTAMP '{as_of_ts}')"
    return f"""
SELECT COALESCE(f.ts, m.ts) AS ts, CAST(COALESCE(f.ts, m.ts) AS DATE) AS day,
       strftime(COALESCE(f.ts, m.ts), '%H:%M') AS hm,
       COALESCE(f.users_feed, 0) AS users_feed, COALESCE(f.views, 0) AS views,
       COALESCE(f.likes, 0) AS likes, CASE WHEN f.ts IS NULL THEN 0 ELSE f.CTR END AS CTR,
       COALESCE(m.users_messenger, 0) AS users_messenger, COALESCE(m.messages, 0) AS messages
FROM (SELECT time_bucket(INTERVAL '15 minutes', time) AS ts, count(DISTINCT user_id) AS users_feed,
             count(user_id) FILTER (WHERE action = 'view') AS views,
             count(user_id) FILTER (WHERE action = 'like') AS likes,
             CAST(count(user_id) FILTER (WHERE action = 'like') AS DOUBLE)
               / nullif(count(user_id) FILTER (WHERE action = 'view'), 0) * 100 AS CTR
      FROM feed_actions WHERE time >= {lo} AND time < {hi} GROUP BY 1) f
FULL JOIN (SELECT time_bucket(INTERVAL '15 minutes', time) AS ts,
                  count(DISTINCT user_id) AS users_messenger, count(reciever_id) AS messages
           FROM message_actions WHERE time >= {lo} AND time < {hi} GROUP BY 1) m
  ON f.ts = m.ts"""


def _long_sql(as_of_ts: dt.datetime) -> str:
    parts = [f"SELECT ts, day, hm, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM s"
             for m in anomaly.SERIES_METRICS]
    return f"WITH s AS ({_series_sql(as_of_ts)})\n" + "\nUNION ALL\n".join(parts)


def _bounds_sql(as_of_ts: dt.datetime, n: int = N, a: float = A) -> str:
    return fences_sql(_long_sql(as_of_ts), n, a, n // 2, (n - 1) // 2)


def fences_sql(long_sql: str, n: int, a: float, lo_off: int, hi_off: int) -> str:
    return f"""
WITH l AS ({long_sql}),
b AS (SELECT *, count(value) OVER w AS cnt,
             quantile_cont(value, 0.25) OVER w AS q25_, quantile_cont(value, 0.75) OVER w AS q75_,
             avg(value) OVER w AS mean_, stddev_samp(value) OVER w AS std_
      FROM l WINDOW w AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)),
c AS (SELECT ts, day, hm, metric, value,
             CASE WHEN cnt = {n} THEN q25_ END AS q25, CASE WHEN cnt = {n} THEN q75_ END AS q75,
             CASE WHEN cnt = {n} THEN mean_ END AS mean, CASE WHEN cnt = {n} THEN std_ END AS std
      FROM b),
d AS (SELECT *, q75 - q25 AS iqr FROM c),
e AS (SELECT *, q25 - {a} * iqr AS low_q0, q75 + {a} * iqr AS up_q0,
             mean - {a} * std AS low_s0, mean + {a} * std AS up_s0 FROM d)
SELECT ts, day, hm, metric, value, q25, q75, iqr, mean, std,
       avg(low_q0) OVER w2 AS low_q, avg(up_q0) OVER w2 AS up_q,
       avg(low_s0) OVER w2 AS low_s, avg(up_s0) OVER w2 AS up_s
FROM e WINDOW w2 AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {lo_off} PRECEDING AND {hi_off} FOLLOWING)"""


def _alerts_sql(as_of_ts: dt.datetime, n: int = N, a: float = A) -> str:
    return f"""
WITH b AS ({_bounds_sql(as_of_ts, n, a)}),
x AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value,
             CASE WHEN low_q = 0 THEN low_s ELSE low_q END AS lower,
             CASE WHEN up_q = 0 THEN up_s ELSE up_q END AS upper,
             max(ts) OVER (PARTITION BY metric) AS last_ts FROM b),
lastv AS (SELECT metric, value AS last_value FROM x WHERE ts = last_ts),
eq AS (SELECT x.metric, list_sort(list(x.hm) FILTER (WHERE x.value = lastv.last_value)) AS equal_slots
       FROM x JOIN lastv ON x.metric = lastv.metric GROUP BY x.metric)
SELECT x.metric, x.ts, x.hm, x.value, x.prev_value,
       abs(1 - x.value / nullif(x.prev_value, 0)) AS deviation, x.lower, x.upper,
       COALESCE(x.value < x.lower OR x.value > x.upper, FALSE) AS is_alert,
       COALESCE(eq.equal_slots, []) AS equal_slots
FROM x JOIN eq ON x.metric = eq.metric WHERE x.ts = x.last_ts"""


_BOUND_DOUBLES = ("value", "q25", "q75", "iqr", "mean", "std", "low_q", "up_q", "low_s", "up_s")


@register("metric_series_15min", _series_sql(AS_OF_TS), doubles=("CTR",))
def q_metric_series_15min(spark, d):
    f, m = load_events(spark, d)
    return anomaly.metric_series_15min(f, m, AS_OF_TS)


@register("metric_series_15min_midday", _series_sql(MIDDAY_TS), doubles=("CTR",))
def q_metric_series_15min_midday(spark, d):
    f, m = load_events(spark, d)
    return anomaly.metric_series_15min(f, m, MIDDAY_TS)


@register("anomaly_bounds", _bounds_sql(AS_OF_TS), doubles=_BOUND_DOUBLES)
def q_anomaly_bounds(spark, d):
    f, m = load_events(spark, d)
    long = anomaly.melt_series(anomaly.metric_series_15min(f, m, AS_OF_TS))
    return anomaly.anomaly_bounds(long, N, A)


@register("anomaly_alerts", _alerts_sql(AS_OF_TS),
          doubles=("value", "prev_value", "deviation", "lower", "upper"))
def q_anomaly_alerts(spark, d):
    f, m = load_events(spark, d)
    long = anomaly.melt_series(anomaly.metric_series_15min(f, m, AS_OF_TS))
    return anomaly.anomaly_alerts(anomaly.anomaly_bounds(long, N, A))


@register("anomaly_alerts_midday", _alerts_sql(MIDDAY_TS),
          doubles=("value", "prev_value", "deviation", "lower", "upper"))
def q_anomaly_alerts_midday(spark, d):
    f, m = load_events(spark, d)
    long = anomaly.melt_series(anomaly.metric_series_15min(f, m, MIDDAY_TS))
    return anomaly.anomaly_alerts(anomaly.anomaly_bounds(long, N, A))


TIGHT_A = 0.25        # narrow fences, so that slots of the given tables do raise alerts


def _tight_alerts(spark, d):
    f, m = load_events(spark, d)
    long = anomaly.melt_series(anomaly.metric_series_15min(f, m, MIDDAY_TS))
    return anomaly.anomaly_alerts(anomaly.anomaly_bounds(long, N, TIGHT_A))


@register("anomaly_alerts_narrow", _alerts_sql(MIDDAY_TS, N, TIGHT_A),
          doubles=("value", "prev_value", "deviation", "lower", "upper"))
def q_anomaly_alerts_narrow(spark, d):
    """Fences so narrow that alerts are raised."""
    return _tight_alerts(spark, d)


@register("alert_messages", f"""
SELECT metric, ts, printf('Metric %s:' || chr(10) || 'current value: %.2f' || chr(10)
       || 'deviation from previous: ', metric, value) || coalesce(printf('%.2f%%', deviation * 100), 'n/a') AS text
FROM ({_alerts_sql(MIDDAY_TS, N, TIGHT_A)}) WHERE is_alert""")
def q_alert_messages(spark, d):
    """Text of the alerts raised for the last slot."""
    return anomaly.alert_messages(_tight_alerts(spark, d))


@register("anomaly_alerts_notebook", _alerts_sql(MIDDAY_TS, 5, 3.0),
          doubles=("value", "prev_value", "deviation", "lower", "upper"))
def q_anomaly_alerts_notebook(spark, d):
    """The notebook's parameters n=5, a=3 (quirk D17)."""
    f, m = load_events(spark, d)
    long = anomaly.melt_series(anomaly.metric_series_15min(f, m, MIDDAY_TS))
    return anomaly.anomaly_alerts(anomaly.anomaly_bounds(long, 5, 3.0))
