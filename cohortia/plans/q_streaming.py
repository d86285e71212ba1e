"""Registered streaming queries.

Each query drains a file stream over the whole ``events`` table with
``trigger(availableNow=True)`` into a table under the session's checkpoint
directory and returns that table.  The oracle is the batch computation
restricted to windows the watermark has closed (end ≤ max event time − delay).
"""

from __future__ import annotations

import uuid

from cohortia.operators.anomaly import SERIES_METRICS
from cohortia.plans.catalog import register
from cohortia.plans.q_anomaly import A, N, fences_sql
from cohortia.session import ensure_checkpoint_dir
from cohortia.streaming import detector
from cohortia.streaming import metrics as sm

_TAGGED = """
SELECT time, user_id, TRUE AS is_feed, CAST(action = 'view' AS INTEGER) AS v,
       CAST(action = 'like' AS INTEGER) AS l, 0 AS m FROM feed_actions
UNION ALL
SELECT time, user_id, FALSE, 0, 0, CAST(reciever_id IS NOT NULL AS INTEGER) FROM message_actions"""


def _table(spark, d, build, mode: str = "append") -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/cohortia_stream_{uuid.uuid4().hex[:12]}"
    ev = sm.read_event_stream(spark, f"{d}/events.parquet")
    sm.run_to_table(build(ev), base + "/table", base + "/checkpoint", mode)
    return base + "/table"


def _run(spark, d, build, mode: str = "append"):
    return spark.read.parquet(_table(spark, d, build, mode))


_CLOSED_SLOTS = f"""
WITH t AS ({_TAGGED}),
wm AS (SELECT max(time) - INTERVAL 30 MINUTE AS wm FROM t),
s AS (SELECT time_bucket(INTERVAL '15 minutes', time) AS ts,
             count(DISTINCT user_id) FILTER (WHERE is_feed) AS users_feed,
             CAST(sum(v) AS BIGINT) AS views, CAST(sum(l) AS BIGINT) AS likes,
             count(DISTINCT user_id) FILTER (WHERE NOT is_feed) AS users_messenger,
             CAST(sum(m) AS BIGINT) AS messages
      FROM t GROUP BY 1)
SELECT ts, users_feed, views, likes,
       CASE WHEN users_feed = 0 THEN 0 ELSE CAST(likes AS DOUBLE) / nullif(views, 0) * 100 END AS CTR,
       users_messenger, messages
FROM s, wm WHERE ts + INTERVAL 15 MINUTE <= wm.wm"""


@register("stream_metrics_15min", _CLOSED_SLOTS, doubles=("CTR",))
def q_stream_metrics_15min(spark, d):
    return _run(spark, d, lambda ev: sm.stream_metrics_15min(sm.tagged_stream(ev), "30 minutes"))


@register("stream_sliding_activity", f"""
WITH t AS ({_TAGGED}),
wm AS (SELECT max(time) - INTERVAL 30 MINUTE AS wm FROM t),
x AS (SELECT time_bucket(INTERVAL '15 minutes', time) - INTERVAL (15 * k) MINUTE AS window_start, v, l, m
      FROM t, range(0, 4) r(k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
       CAST(sum(v) AS BIGINT) AS views, CAST(sum(l) AS BIGINT) AS likes, CAST(sum(m) AS BIGINT) AS messages
FROM x, wm GROUP BY window_start, wm.wm HAVING window_start + INTERVAL 1 HOUR <= wm.wm""")
def q_stream_sliding_activity(spark, d):
    return _run(spark, d, lambda ev: sm.stream_sliding_activity(sm.tagged_stream(ev)))


@register("stream_sessions", f"""
WITH t AS ({_TAGGED}),
wm AS (SELECT max(time) - INTERVAL 1 HOUR AS wm FROM t),
g AS (SELECT *, CASE WHEN lag(time) OVER (PARTITION BY user_id ORDER BY time) IS NULL
                       OR time - lag(time) OVER (PARTITION BY user_id ORDER BY time) >= INTERVAL 30 MINUTE
                     THEN 1 ELSE 0 END AS new_s FROM t),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY time
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
a AS (SELECT user_id, min(time) AS session_start, max(time) + INTERVAL 30 MINUTE AS session_end,
             count(*) AS events, CAST(sum(v) AS BIGINT) AS views, CAST(sum(l) AS BIGINT) AS likes,
             CAST(sum(m) AS BIGINT) AS messages
      FROM s GROUP BY user_id, sid)
SELECT a.* FROM a, wm WHERE a.session_end <= wm.wm""")
def q_stream_sessions(spark, d):
    return _run(spark, d, lambda ev: sm.stream_sessions(sm.tagged_stream(ev), "30 minutes", "1 hour"))


@register("stream_dedup", """
SELECT event_id, user_id, event_type FROM events""")
def q_stream_dedup(spark, d):
    """The stream holds every event twice."""
    return _run(spark, d, lambda ev: sm.stream_dedup(ev.unionByName(ev)).select("event_id", "user_id", "event_type"))


_LONG = f"WITH s AS ({_CLOSED_SLOTS})\n" + "\nUNION ALL\n".join(
    f"SELECT ts, CAST(ts AS DATE) AS day, strftime(ts, '%H:%M') AS hm, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM s"
    for m in SERIES_METRICS)


_VERDICTS = f"""
WITH b AS ({fences_sql(_LONG, N, A, N // 2, 0)}),
x AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value,
             CASE WHEN low_q = 0 THEN low_s ELSE low_q END AS lower,
             CASE WHEN up_q = 0 THEN up_s ELSE up_q END AS upper FROM b)
SELECT metric, ts, hm, value, prev_value, abs(1 - value / nullif(prev_value, 0)) AS deviation, lower, upper,
       COALESCE(value < lower OR value > upper, FALSE) AS is_alert
FROM x"""
_VERDICT_DOUBLES = ("value", "prev_value", "deviation", "lower", "upper")


@register("stream_anomaly_alerts", _VERDICTS, doubles=_VERDICT_DOUBLES)
def q_stream_anomaly_alerts(spark, d):
    """Closed slots → series table → detector in ``foreachBatch`` → a verdict for every closed slot."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/cohortia_alerts_{uuid.uuid4().hex[:12]}"
    ev = sm.read_event_stream(spark, f"{d}/events.parquet")
    stream = sm.stream_metrics_15min(sm.tagged_stream(ev), "30 minutes")
    q = (stream.writeStream.outputMode("append")
         .foreachBatch(sm.alert_batch_writer(base + "/series", base + "/alerts"))
         .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/alerts").drop("epoch_id")


@register("stream_anomaly_stateful", _VERDICTS, doubles=_VERDICT_DOUBLES)
def q_stream_anomaly_stateful(spark, d):
    """Closed slots → series table → keyed state of the last slots → a verdict for every closed slot."""
    path = _table(spark, d, lambda ev: sm.stream_metrics_15min(sm.tagged_stream(ev), "30 minutes"))
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/cohortia_detector_{uuid.uuid4().hex[:12]}"
    verdicts = detector.detect_stream(detector.series_stream(spark, path, spark.read.parquet(path).schema), N, A)
    sm.run_to_table(verdicts, base + "/verdicts", base + "/checkpoint")
    return spark.read.schema(verdicts.schema).parquet(base + "/verdicts")
