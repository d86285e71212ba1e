"""Registered daily-ETL queries."""

from __future__ import annotations

import datetime as dt
import uuid

from cohortia.operators import etl
from cohortia.plans.catalog import YESTERDAY, register
from cohortia.session import ensure_checkpoint_dir
from cohortia.sources.events import load_events
from cohortia.sources.sinks import load_day, read_fact, read_loaded, write_fact

Y = YESTERDAY.isoformat()
_M = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]


def _feed_x_sql(view_literal: str = "view") -> str:
    return f"""
SELECT CAST(time AS DATE) AS event_date, user_id AS "user", gender, age, os,
       count(*) FILTER (WHERE action = 'like') AS likes,
       count(*) FILTER (WHERE action = '{view_literal}') AS views
FROM feed_actions WHERE CAST(time AS DATE) = DATE '{Y}' GROUP BY 1, 2, 3, 4, 5"""


_SENT = f"""
SELECT CAST(time AS DATE) AS event_date, user_id AS "user", gender, age, os,
       count(reciever_id) AS messages_sent, count(DISTINCT reciever_id) AS users_sent
FROM message_actions WHERE CAST(time AS DATE) = DATE '{Y}' GROUP BY 1, 2, 3, 4, 5"""


def _msg_x_sql() -> str:
    return f"""
WITH s AS ({_SENT}),
r AS (SELECT CAST(time AS DATE) AS event_date, reciever_id AS "user", count(user_id) AS messages_received,
             count(DISTINCT user_id) AS users_received
      FROM message_actions WHERE CAST(time AS DATE) = DATE '{Y}' AND reciever_id IS NOT NULL GROUP BY 1, 2)
SELECT COALESCE(s.event_date, r.event_date) AS event_date, COALESCE(s."user", r."user") AS "user",
       s.gender, s.age, s.os,
       COALESCE(s.messages_sent, 0) AS messages_sent, COALESCE(r.messages_received, 0) AS messages_received,
       COALESCE(s.users_sent, 0) AS users_sent, COALESCE(r.users_received, 0) AS users_received
FROM s FULL JOIN r ON s.event_date = r.event_date AND s."user" = r."user"
"""


def _msg_x_compat_sql() -> str:
    return f"""
WITH s AS ({_SENT}),
r AS (SELECT CAST(time AS DATE) AS event_date, reciever_id AS "user", gender, age, os,
             count(user_id) AS messages_received, count(DISTINCT user_id) AS users_received
      FROM message_actions WHERE CAST(time AS DATE) = DATE '{Y}' GROUP BY 1, 2, 3, 4, 5)
SELECT COALESCE(s.event_date, DATE '1970-01-01') AS event_date, COALESCE(s."user", 0) AS "user",
       COALESCE(s.gender, 0) AS gender, COALESCE(s.age, 0) AS age, COALESCE(s.os, '') AS os,
       COALESCE(s.messages_sent, 0) AS messages_sent, COALESCE(r.messages_received, 0) AS messages_received,
       COALESCE(s.users_sent, 0) AS users_sent, COALESCE(r.users_received, 0) AS users_received
FROM s FULL JOIN r ON s."user" = r."user\""""


def _merge_sql(feed_sql: str, msg_sql: str) -> str:
    cols = ", ".join(f"m.{c}" if c.startswith(("messages", "users")) else f"f.{c}" for c in _M)
    return f"""
SELECT f.event_date, f."user", f.gender, f.age, f.os, {cols}
FROM ({feed_sql}) f JOIN ({msg_sql}) m
  ON f."user" = m."user" AND f.event_date = m.event_date AND (m.gender IS NULL OR f.gender = m.gender)
 AND (m.age IS NULL OR f.age = m.age) AND (m.os IS NULL OR f.os = m.os)"""


def _sums() -> str:
    return ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _M)


def _slices_sql(merge: str) -> str:
    parts = [f"SELECT event_date, '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value, {_sums()} "
             f"FROM ({merge}) x GROUP BY 1, 2, 3" for d in ("gender", "age", "os")]
    return "\nUNION ALL\n".join(parts)


def _fact_sql(merge: str) -> str:
    return f"SELECT event_date, gender, age, os, {_sums()} FROM ({merge}) x GROUP BY 1, 2, 3, 4"


_MERGE = _merge_sql(_feed_x_sql(), _msg_x_sql())
_MERGE_COMPAT = _merge_sql(_feed_x_sql("views"), _msg_x_compat_sql())


def _ev(spark, d):
    return load_events(spark, d)


@register("etl_feed_extract", _feed_x_sql())
def q_etl_feed_extract(spark, d):
    f, _ = _ev(spark, d)
    return etl.etl_feed_extract(f, YESTERDAY)


@register("etl_feed_extract_compat", _feed_x_sql("views"))
def q_etl_feed_extract_compat(spark, d):
    f, _ = _ev(spark, d)
    return etl.etl_feed_extract(f, YESTERDAY, view_action="views")


@register("etl_messenger_extract", _msg_x_sql())
def q_etl_messenger_extract(spark, d):
    _, m = _ev(spark, d)
    return etl.etl_messenger_extract(m, YESTERDAY, "receiver")


@register("etl_messenger_extract_compat", _msg_x_compat_sql())
def q_etl_messenger_extract_compat(spark, d):
    _, m = _ev(spark, d)
    return etl.etl_messenger_extract(m, YESTERDAY, "sender_groups")


def _merged(spark, d, compat: bool = False):
    f, m = _ev(spark, d)
    if compat:
        return etl.etl_merge(etl.etl_feed_extract(f, YESTERDAY, "views"),
                             etl.etl_messenger_extract(m, YESTERDAY, "sender_groups"))
    return etl.etl_merge(etl.etl_feed_extract(f, YESTERDAY),
                         etl.etl_messenger_extract(m, YESTERDAY, "receiver"))


@register("etl_merge", _MERGE)
def q_etl_merge(spark, d):
    return _merged(spark, d)


@register("etl_slices", _slices_sql(_MERGE))
def q_etl_slices(spark, d):
    return etl.etl_slices(_merged(spark, d))


@register("etl_fact", _fact_sql(_MERGE))
def q_etl_fact(spark, d):
    return etl.etl_fact(_merged(spark, d))


@register("etl_fact_compat", _fact_sql(_MERGE_COMPAT))
def q_etl_fact_compat(spark, d):
    return etl.etl_fact(_merged(spark, d, compat=True))


@register("etl_fact_table", _fact_sql(_MERGE))
def q_etl_fact_table(spark, d):
    """The fact is written to a date-partitioned table (twice, to show the
    re-run replaces the day instead of appending) and read back."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cohortia_fact_{uuid.uuid4().hex}"
    fact = etl.etl_fact(_merged(spark, d))
    write_fact(fact, path)
    write_fact(fact, path)
    out = read_fact(spark, path)
    return out.select("event_date", "gender", "age", "os", *_M)


_BEFORE = YESTERDAY - dt.timedelta(days=1)
_TWO_DAYS = f"{_fact_sql(_MERGE)}\nUNION ALL\n" + _fact_sql(_MERGE).replace(f"DATE '{Y}'", f"DATE '{_BEFORE}'")


@register("etl_fact_loads", _TWO_DAYS)
def q_etl_fact_loads(spark, d):
    """Two days are loaded, one of them again from corrected rows; an older run that comes
    late and a run that is started twice change nothing."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortia_loads_{uuid.uuid4().hex}"
    f, m = _ev(spark, d)
    wrong = etl.daily_fact(f, m, YESTERDAY, "sender_groups", "views")
    load_day(etl.daily_fact(f, m, _BEFORE), path, _BEFORE, run=1)
    load_day(wrong, path, YESTERDAY, run=1)
    load_day(etl.daily_fact(f, m, YESTERDAY), path, YESTERDAY, run=3)
    load_day(wrong, path, YESTERDAY, run=2)
    load_day(wrong, path, YESTERDAY, run=3)
    return read_loaded(spark, path).select("event_date", "gender", "age", "os", *_M)


@register("etl_fact_tsv", _fact_sql(_MERGE))
def q_etl_fact_tsv(spark, d):
    """The fact exported as TSV with a header, read back with the fact schema."""
    from cohortia.sources.sinks import export_tsv
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cohortia_fact_tsv_{uuid.uuid4().hex}"
    fact = etl.etl_fact(_merged(spark, d))
    export_tsv(fact, path)
    return spark.read.schema(fact.schema).option("sep", "\t").option("header", True).csv(path)
