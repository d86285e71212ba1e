"""Registered activity / report queries."""

from __future__ import annotations

import datetime as dt

from cohortia.operators import activity as act
from cohortia.plans.catalog import AS_OF, EARLY_DAY, YESTERDAY, register
from cohortia.plans.sqlparts import STATUS_CASE, user_day_activity_sql, user_slot_activity_sql
from cohortia.sources.events import load_events

Y = YESTERDAY.isoformat()


@register("user_day_activity", user_day_activity_sql())
def q_user_day_activity(spark, d):
    f, m = load_events(spark, d)
    return act.user_day_activity(f, m)


@register("user_slot_activity", user_slot_activity_sql(Y))
def q_user_slot_activity(spark, d):
    f, m = load_events(spark, d)
    return act.user_slot_activity(f, m, YESTERDAY)


@register("dau_by_status", f"""
SELECT day, count(*) AS dau,
       count(*) FILTER (WHERE messages = 0) AS dau_feed_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes = 0) AS dau_messenger_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes > 0) AS dau_feed_messenger
FROM ({user_day_activity_sql()}) a GROUP BY day""")
def q_dau_by_status(spark, d):
    f, m = load_events(spark, d)
    return act.dau_by_status(act.user_day_activity(f, m), "day")


@register("dau_by_status_slot", f"""
SELECT mins_15, count(*) AS dau,
       count(*) FILTER (WHERE messages = 0) AS dau_feed_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes = 0) AS dau_messenger_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes > 0) AS dau_feed_messenger
FROM ({user_slot_activity_sql(Y)}) a GROUP BY mins_15""")
def q_dau_by_status_slot(spark, d):
    f, m = load_events(spark, d)
    return act.dau_by_status(act.user_slot_activity(f, m, YESTERDAY), "mins_15")


@register("event_totals_daily", f"""
SELECT day, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes,
       CAST(sum(messages) AS BIGINT) AS messages
FROM ({user_day_activity_sql()}) a GROUP BY day""")
def q_event_totals_daily(spark, d):
    f, m = load_events(spark, d)
    return act.event_totals(act.user_day_activity(f, m), "day")


@register("event_totals_slot", f"""
SELECT strftime(mins_15, '%H-%M') AS hours_mins, CAST(sum(views) AS BIGINT) AS views,
       CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(messages) AS BIGINT) AS messages
FROM ({user_slot_activity_sql(Y)}) a GROUP BY 1""")
def q_event_totals_slot(spark, d):
    f, m = load_events(spark, d)
    return act.event_totals(act.user_slot_activity(f, m, YESTERDAY), "mins_15", label="hours_mins")


@register("avg_events_daily", f"""
SELECT day, avg(views) FILTER (WHERE views > 0) AS views_avg,
       avg(likes) FILTER (WHERE likes > 0) AS likes_avg,
       avg(messages) FILTER (WHERE messages > 0) AS messages_avg
FROM ({user_day_activity_sql()}) a GROUP BY day""",
          doubles=("views_avg", "likes_avg", "messages_avg"))
def q_avg_events_daily(spark, d):
    f, m = load_events(spark, d)
    return act.avg_events_daily(act.user_day_activity(f, m))


@register("avg_events_per_user", f"""
SELECT DATE '{Y}' AS day,
       avg(views) FILTER (WHERE views > 0) AS views_avg,
       avg(likes) FILTER (WHERE likes > 0) AS likes_avg,
       avg(messages) FILTER (WHERE messages > 0) AS messages_avg
FROM (SELECT user_id, sum(views) AS views, sum(likes) AS likes, sum(messages) AS messages
      FROM ({user_slot_activity_sql(Y)}) s GROUP BY user_id) a""",
          doubles=("views_avg", "likes_avg", "messages_avg"))
def q_avg_events_per_user(spark, d):
    f, m = load_events(spark, d)
    return act.avg_events_per_user(f, m, YESTERDAY)


def _new_users_sql(day: str) -> str:
    return f"""
SELECT user_id FROM (SELECT user_id, CAST(time AS DATE) AS day FROM feed_actions
                     UNION ALL SELECT user_id, CAST(time AS DATE) FROM message_actions)
GROUP BY user_id HAVING min(day) = DATE '{day}'"""


@register("new_users_on_day", _new_users_sql(EARLY_DAY.isoformat()))
def q_new_users_on_day(spark, d):
    f, m = load_events(spark, d)
    return act.new_users_on(f, m, EARLY_DAY)


@register("new_users_on_yesterday", _new_users_sql((EARLY_DAY - dt.timedelta(days=1)).isoformat()))
def q_new_users_on_yesterday(spark, d):
    """The day before a day on which users still join in the test data."""
    f, m = load_events(spark, d)
    return act.new_users_on(f, m, EARLY_DAY - dt.timedelta(days=1))


@register("new_users_daily", f"""
SELECT birthday, status, count(*) AS new_users FROM (
  SELECT user_id, min(day) AS birthday, arg_min(status, day) AS status
  FROM (SELECT *, {STATUS_CASE} AS status FROM ({user_day_activity_sql()}) a) s
  GROUP BY user_id) u
GROUP BY birthday, status""")
def q_new_users_daily(spark, d):
    f, m = load_events(spark, d)
    return act.new_users_daily(act.user_day_activity(f, m))


@register("feed_daily_report", f"""
SELECT CAST(time AS DATE) AS day, count(DISTINCT user_id) AS dau,
       count(user_id) FILTER (WHERE action = 'view') AS views,
       count(user_id) FILTER (WHERE action = 'like') AS likes,
       100.0 * (count(user_id) FILTER (WHERE action = 'like'))
             / nullif(count(user_id) FILTER (WHERE action = 'view'), 0) AS ctr
FROM feed_actions
WHERE CAST(time AS DATE) BETWEEN DATE '{AS_OF.isoformat()}' - 7 AND DATE '{AS_OF.isoformat()}' - 1
GROUP BY 1""", doubles=("ctr",))
def q_feed_daily_report(spark, d):
    f, _ = load_events(spark, d)
    return act.feed_daily_report(f, AS_OF, 7)


@register("dau_last_complete_day", f"""
WITH a AS ({user_day_activity_sql()}),
d AS (SELECT max(day) AS d FROM a WHERE day < (SELECT max(day) FROM a))
SELECT day, count(*) AS dau,
       count(*) FILTER (WHERE messages = 0) AS dau_feed_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes = 0) AS dau_messenger_only,
       count(*) FILTER (WHERE messages > 0 AND views + likes > 0) AS dau_feed_messenger
FROM a WHERE day = (SELECT d FROM d) GROUP BY day""")
def q_dau_last_complete_day(spark, d):
    f, m = load_events(spark, d)
    return act.dau_on_last_complete_day(act.user_day_activity(f, m))


@register("feed_report_latest_day", f"""
WITH r AS (
SELECT CAST(time AS DATE) AS day, count(DISTINCT user_id) AS dau,
       count(user_id) FILTER (WHERE action = 'view') AS views,
       count(user_id) FILTER (WHERE action = 'like') AS likes,
       CAST(count(user_id) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(user_id) FILTER (WHERE action = 'view'), 0) * 100 AS ctr
FROM feed_actions
WHERE CAST(time AS DATE) BETWEEN DATE '{AS_OF.isoformat()}' - 7 AND DATE '{AS_OF.isoformat()}' - 1
GROUP BY 1)
SELECT * FROM r WHERE day = (SELECT max(day) FROM r)""", doubles=("ctr",))
def q_feed_report_latest_day(spark, d):
    f, _ = load_events(spark, d)
    return act.latest_rows(act.feed_daily_report(f, AS_OF, 7), "day")


@register("feed_report_text", f"""
WITH r AS (
SELECT CAST(time AS DATE) AS day, count(DISTINCT user_id) AS dau,
       count(user_id) FILTER (WHERE action = 'view') AS views,
       count(user_id) FILTER (WHERE action = 'like') AS likes
FROM feed_actions
WHERE CAST(time AS DATE) BETWEEN DATE '{AS_OF.isoformat()}' - 7 AND DATE '{AS_OF.isoformat()}' - 1
GROUP BY 1),
m AS (SELECT day, 'dau' AS metric, CAST(dau AS DOUBLE) AS value FROM r
      UNION ALL SELECT day, 'views', CAST(views AS DOUBLE) FROM r
      UNION ALL SELECT day, 'likes', CAST(likes AS DOUBLE) FROM r)
SELECT strftime(day, '%d.%m.%Y') AS day, metric, value,
       metric || ' - ' || replace(format('{{:,.0f}}', value), ',', ' ') AS text
FROM m""", doubles=("value",))
def q_feed_report_text(spark, d):
    """Report rows with '12 345'-style numbers and dd.MM.yyyy dates."""
    from cohortia.sources.sinks import report_rows
    f, _ = load_events(spark, d)
    return report_rows(act.feed_daily_report(f, AS_OF, 7), ["dau", "views", "likes"])
