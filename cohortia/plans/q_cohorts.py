"""Registered retention, lifecycle, audience and drop-analysis queries."""

from __future__ import annotations

import datetime as dt
import uuid

from cohortia.operators import audience as aud
from cohortia.operators import drivers, lifecycle, overview, retention, retention_bitmaps, sketches
from cohortia.plans.catalog import AS_OF, YESTERDAY, register
from cohortia.session import ensure_checkpoint_dir
from cohortia.sources.events import load_events, orders_activity

A = AS_OF.isoformat()
Y = YESTERDAY.isoformat()
ORDERS_AS_OF = dt.date(2001, 8, 2)
SOURCE_AS_OF = dt.date(2024, 1, 21)     # its 20 days hold birthdays in the test data
PERIOD = (dt.date(2024, 1, 1), YESTERDAY)
WEEK = (dt.date(2024, 1, 15), dt.date(2024, 1, 21))


def _user_days_sql(table: str = "feed_actions") -> str:
    """One row per user and active day, with the user's first day and (largest) source."""
    return f"""
SELECT user_id, day, min(day) OVER w AS birthday, max(src) OVER w AS source
FROM (SELECT user_id, CAST(time AS DATE) AS day, max(source) AS src FROM {table} GROUP BY user_id, CAST(time AS DATE))
WINDOW w AS (PARTITION BY user_id)"""


_RETENTION_SQL = f"""
WITH d AS ({_user_days_sql()}),
size AS (SELECT birthday, count(DISTINCT user_id) AS size FROM d GROUP BY birthday)
SELECT d.birthday AS cohort, CAST(d.day - d.birthday AS INTEGER) AS days_distance, count(*) AS num_of_users,
       CAST(count(*) AS DOUBLE) / any_value(size) AS retention_rate
FROM d JOIN size ON size.birthday = d.birthday GROUP BY d.birthday, d.day"""


@register("retention_by_distance", _RETENTION_SQL, doubles=("retention_rate",))
def q_retention_by_distance(spark, d):
    f, _ = load_events(spark, d)
    return retention.retention_by_distance(f)


@register("retention_incremental", _RETENTION_SQL, doubles=("retention_rate",))
def q_retention_incremental(spark, d):
    """Bitmaps of all days but the last, then the last day added to them."""
    f, _ = load_events(spark, d)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortia_retention_{uuid.uuid4().hex}"
    retention_bitmaps.build_retention(f, path, YESTERDAY - dt.timedelta(days=1))
    retention_bitmaps.add_day(f, path, YESTERDAY)
    return retention_bitmaps.stored_retention(spark, path)


@register("first_cohort_retention", f"""
WITH d AS ({_user_days_sql()})
SELECT day, count(*) AS num_users FROM d WHERE birthday = (SELECT min(day) FROM d) GROUP BY day""")
def q_first_cohort_retention(spark, d):
    f, _ = load_events(spark, d)
    return retention.first_cohort_retention(f)


def _retention_source_sql(table: str, lo: str, hi: str, bound_days: bool, strings: bool) -> str:
    shown = "CAST({0} AS VARCHAR) AS {0}" if strings else "{0}"
    return f"""
SELECT {shown.format('birthday')}, {shown.format('day')}, source, count(*) AS num_of_users
FROM (SELECT birthday, day, source FROM ({_user_days_sql(table)})
      WHERE birthday >= {lo} AND birthday <= {hi}{f" AND day >= {lo} AND day <= {hi}" if bound_days else ""}) c
GROUP BY ALL"""


@register("retention_by_source", _retention_source_sql(
    "feed_actions", f"DATE '{SOURCE_AS_OF}' - 20", f"DATE '{SOURCE_AS_OF}'", False, True))
def q_retention_by_source(spark, d):
    f, _ = load_events(spark, d)
    return retention.retention_by_source(f, SOURCE_AS_OF, 20)


@register("retention_by_source_30d", _retention_source_sql(
    "feed_actions", f"DATE '{A}' - 30", f"DATE '{A}'", False, True))
def q_retention_by_source_30d(spark, d):
    f, _ = load_events(spark, d)
    return retention.retention_by_source(f, AS_OF, 30)


def _app_retention_sql(bound: bool, strings: bool) -> str:
    lo, hi = f"DATE '{A}' - 30", f"DATE '{A}' - 1"
    return f"""
SELECT birthday, day, source, CAST(sum(num_of_users) AS BIGINT) AS num_of_users FROM (
{_retention_source_sql('feed_actions', lo, hi, bound, strings)}
UNION ALL
{_retention_source_sql('message_actions', lo, hi, bound, strings)}
) u GROUP BY birthday, day, source"""


@register("app_retention", _app_retention_sql(False, True))
def q_app_retention(spark, d):
    f, m = load_events(spark, d)
    return retention.app_retention(f, m, AS_OF, 30, bound_days=False, as_strings=True)


@register("app_retention_dates", _app_retention_sql(True, False))
def q_app_retention_dates(spark, d):
    f, m = load_events(spark, d)
    return retention.app_retention(f, m, AS_OF, 30, bound_days=True, as_strings=False)


_APP_DISTINCT = f"""
SELECT birthday, day, source, count(DISTINCT user_id) AS num_of_users
FROM (SELECT l.user_id, CAST(l.time AS DATE) AS day, r.birthday, r.source
      FROM (SELECT user_id, time FROM feed_actions UNION ALL SELECT user_id, time FROM message_actions) l
      JOIN (SELECT user_id, min(CAST(time AS DATE)) AS birthday, max(source) AS source
            FROM (SELECT user_id, time, source FROM feed_actions
                  UNION ALL SELECT user_id, time, source FROM message_actions) x
            GROUP BY user_id) r ON l.user_id = r.user_id
      WHERE r.birthday BETWEEN DATE '{A}' - 30 AND DATE '{A}' - 1
        AND CAST(l.time AS DATE) BETWEEN DATE '{A}' - 30 AND DATE '{A}' - 1) c
GROUP BY 1, 2, 3"""


@register("app_retention_distinct", _APP_DISTINCT)
def q_app_retention_distinct(spark, d):
    f, m = load_events(spark, d)
    return retention.app_retention_distinct(f, m, AS_OF, 30)


@register("campaign_cohort_compare", f"""
WITH r AS (SELECT birthday, day, CAST(sum(num_of_users) AS BIGINT) AS num_of_users,
                  CAST(date_diff('day', birthday, day) AS INTEGER) AS days_distance
           FROM ({_APP_DISTINCT}) a GROUP BY birthday, day),
s AS (SELECT *, max(CASE WHEN days_distance = 0 THEN num_of_users END)
                  OVER (PARTITION BY birthday) AS cohort_size FROM r)
SELECT birthday, days_distance, num_of_users, cohort_size,
       CAST(cohort_size AS DOUBLE) / (SELECT quantile_cont(num_of_users, 0.5) FROM r
                                      WHERE days_distance = 0) AS size_ratio,
       CAST(num_of_users AS DOUBLE) / quantile_cont(num_of_users, 0.5)
         OVER (PARTITION BY days_distance) AS activity_ratio
FROM s""", doubles=("size_ratio", "activity_ratio"))
def q_campaign_cohort_compare(spark, d):
    f, m = load_events(spark, d)
    return retention.campaign_cohort_compare(f, m, AS_OF, 30)


def _lifecycle_sql(table: str, as_of: str, strict: bool = False) -> str:
    """A user's active weeks in order; a week follows the one before it or a gap."""
    back = "resurrected" if strict else "new"
    return f"""
WITH uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', time) AS DATE) AS w FROM {table}),
x AS (SELECT user_id, w, lag(w) OVER (PARTITION BY user_id ORDER BY w) AS pw,
             lead(w) OVER (PARTITION BY user_id ORDER BY w) AS nw FROM uw),
rows_ AS (
  SELECT user_id, w AS this_week, w - 7 AS previous_week,
         CASE WHEN pw = w - 7 THEN 'retained' WHEN pw IS NULL THEN 'new' ELSE '{back}' END AS status
  FROM x
  UNION ALL
  SELECT user_id, w + 7, w, 'gone' FROM x
  WHERE (nw IS NULL OR nw != w + 7) AND w != CAST(date_trunc('week', DATE '{as_of}') AS DATE))
SELECT this_week, previous_week,
       CASE WHEN status = 'gone' THEN -count(*) ELSE count(*) END AS num_users, status
FROM rows_ GROUP BY this_week, previous_week, status"""


@register("user_lifecycle_weekly", _lifecycle_sql("feed_actions", A))
def q_user_lifecycle_weekly(spark, d):
    f, _ = load_events(spark, d)
    return lifecycle.user_lifecycle_weekly(f, AS_OF)


@register("user_lifecycle_weekly_orders", _lifecycle_sql("orders_activity", ORDERS_AS_OF.isoformat()))
def q_user_lifecycle_weekly_orders(spark, d):
    return lifecycle.user_lifecycle_weekly(orders_activity(spark, d), ORDERS_AS_OF)


@register("user_lifecycle_strict_orders", _lifecycle_sql("orders_activity", ORDERS_AS_OF.isoformat(), strict=True))
def q_user_lifecycle_strict_orders(spark, d):
    return lifecycle.user_lifecycle_weekly(orders_activity(spark, d), ORDERS_AS_OF, strict_new=True)


_WAU_MAU_SQL = f"""
WITH ud AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS day FROM feed_actions),
days AS (SELECT CAST(range AS DATE) AS day
         FROM range(TIMESTAMP '{PERIOD[0]}', TIMESTAMP '{PERIOD[1]}' + INTERVAL 1 DAY, INTERVAL 1 DAY))
SELECT d.day,
       count(DISTINCT u.user_id) FILTER (WHERE u.day = d.day) AS dau,
       count(DISTINCT u.user_id) FILTER (WHERE u.day > d.day - 7) AS wau,
       count(DISTINCT u.user_id) AS mau,
       CAST(count(DISTINCT u.user_id) FILTER (WHERE u.day = d.day) AS DOUBLE)
         / count(DISTINCT u.user_id) AS stickiness
FROM days d JOIN ud u ON u.day BETWEEN d.day - 29 AND d.day
GROUP BY d.day"""


@register("wau_mau_stickiness", _WAU_MAU_SQL, doubles=("stickiness",))
def q_wau_mau_stickiness(spark, d):
    f, _ = load_events(spark, d)
    return aud.wau_mau_stickiness(f, *PERIOD)


def _stored_sketches(spark, d):
    """Daily sketches of the feed, written as the daily job would and read back."""
    f, _ = load_events(spark, d)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches_{uuid.uuid4().hex}"
    made = sketches.daily_user_sketches(f)
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@register("wau_mau_from_sketches", _WAU_MAU_SQL, doubles=("stickiness",))
def q_wau_mau_from_sketches(spark, d):
    """Estimates; all but exact at the oracle's numbers of users."""
    return sketches.active_users_from_sketches(_stored_sketches(spark, d), *PERIOD)


@register("weekly_change_from_sketches", """
WITH uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', time) AS DATE) AS w FROM feed_actions),
x AS (SELECT w, count(*) AS users, count(*) FILTER (WHERE (user_id, w - 7) IN (SELECT user_id, w FROM uw)) AS retained
      FROM uw GROUP BY w)
SELECT x.w AS this_week, x.users, x.retained, x.users - x.retained AS new, coalesce(b.users, 0) - x.retained AS gone
FROM x LEFT JOIN x b ON b.w = x.w - 7""")
def q_weekly_change_from_sketches(spark, d):
    return sketches.weekly_change_from_sketches(_stored_sketches(spark, d))


@register("audience_distribution", """
SELECT 'age' AS dimension, age AS value, count(DISTINCT user_id) AS users,
       CAST(count(DISTINCT user_id) AS DOUBLE) / (SELECT count(DISTINCT user_id) FROM feed_actions) AS share
FROM feed_actions GROUP BY age""", doubles=("share",))
def q_audience_distribution(spark, d):
    f, _ = load_events(spark, d)
    return aud.audience_distribution(f, "age")


@register("kpi_card", f"""
WITH t AS (SELECT * FROM feed_actions WHERE CAST(time AS DATE) = DATE '{Y}'),
p AS (SELECT DISTINCT user_id FROM feed_actions WHERE CAST(time AS DATE) = DATE '{Y}' - 1)
SELECT DATE '{Y}' AS day, count(DISTINCT user_id) AS users, count(DISTINCT post_id) AS posts,
       count(*) FILTER (WHERE action = 'view') AS views,
       count(*) FILTER (WHERE action = 'like') AS likes,
       CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr,
       CAST(count(*) FILTER (WHERE action = 'view') AS DOUBLE) / nullif(count(DISTINCT user_id), 0) AS avg_views,
       CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE) / nullif(count(DISTINCT user_id), 0) AS avg_likes,
       (SELECT CAST(count(*) FILTER (WHERE user_id IN (SELECT user_id FROM t)) AS DOUBLE)
               / nullif(count(*), 0) FROM p) AS retention_1d
FROM t""", doubles=("ctr", "avg_views", "avg_likes", "retention_1d"))
def q_kpi_card(spark, d):
    f, _ = load_events(spark, d)
    return aud.kpi_card(f, YESTERDAY)


@register("top_posts", """
SELECT post_id, count(*) FILTER (WHERE action = 'view') AS views,
       count(*) FILTER (WHERE action = 'like') AS likes, count(DISTINCT user_id) AS users,
       CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr
FROM feed_actions GROUP BY post_id ORDER BY views DESC, post_id LIMIT 10""", doubles=("ctr",))
def q_top_posts(spark, d):
    f, _ = load_events(spark, d)
    return aud.top_posts(f, 10, "views")


@register("top_users", """
SELECT user_id, count(*) FILTER (WHERE action = 'view') AS views,
       count(*) FILTER (WHERE action = 'like') AS likes, count(DISTINCT post_id) AS posts
FROM feed_actions WHERE source = 'ads' GROUP BY user_id ORDER BY likes DESC, user_id LIMIT 10""")
def q_top_users(spark, d):
    f, _ = load_events(spark, d)
    return aud.top_users(f, 10, "likes", source="ads")


@register("live_offsets", f"""
WITH s AS (SELECT time_bucket(INTERVAL '15 minutes', time) AS slot, CAST(time AS DATE) AS day,
                  count(DISTINCT user_id) AS users, count(*) FILTER (WHERE action = 'view') AS views,
                  count(*) FILTER (WHERE action = 'like') AS likes
           FROM feed_actions GROUP BY 1, 2),
t AS (SELECT slot AS ts FROM s WHERE day = DATE '{Y}'
      UNION SELECT slot + INTERVAL 1 DAY FROM s WHERE day = DATE '{Y}' - 1
      UNION SELECT slot + INTERVAL 7 DAY FROM s WHERE day = DATE '{Y}' - 7)
SELECT t.ts, strftime(t.ts, '%H:%M') AS hm,
       coalesce(a.users, 0) AS users, coalesce(a.views, 0) AS views, coalesce(a.likes, 0) AS likes,
       coalesce(b.users, 0) AS users_1d, coalesce(b.views, 0) AS views_1d, coalesce(b.likes, 0) AS likes_1d,
       coalesce(c.users, 0) AS users_7d, coalesce(c.views, 0) AS views_7d, coalesce(c.likes, 0) AS likes_7d
FROM t LEFT JOIN s a ON a.slot = t.ts
LEFT JOIN s b ON b.slot = t.ts - INTERVAL 1 DAY
LEFT JOIN s c ON c.slot = t.ts - INTERVAL 7 DAY""")
def q_live_offsets(spark, d):
    f, _ = load_events(spark, d)
    return aud.live_offsets(f, YESTERDAY, (1, 7))


@register("interaction_audience", """
WITH u AS (SELECT user_id, max(value) AS value, max(fe) AS fe, max(me) AS me
           FROM (SELECT user_id, os AS value, 1 AS fe, 0 AS me FROM feed_actions
                 UNION ALL SELECT user_id, os, 0, 1 FROM message_actions) x GROUP BY user_id)
SELECT 'os' AS dimension, CAST(value AS VARCHAR) AS value,
       CASE WHEN fe = 1 AND me = 1 THEN 'feed+messenger' WHEN fe = 1 THEN 'feed_only'
            ELSE 'messenger_only' END AS status,
       count(*) AS users
FROM u GROUP BY 1, 2, 3""")
def q_interaction_audience(spark, d):
    f, m = load_events(spark, d)
    return aud.interaction_audience(f, m, "os", *PERIOD)


_DISTRIBUTIONS_SQL = " UNION ALL ".join(f"""
SELECT 'distribution' AS section, '{x}' AS key, CAST({x} AS VARCHAR) AS part, count(DISTINCT user_id) AS users
FROM feed_actions WHERE CAST(time AS DATE) BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY {x}""" for x in overview.DIMS)
_ACTIVE_SQL = " UNION ALL ".join(f"""
SELECT '{name}', CAST(g AS VARCHAR), CAST(NULL AS VARCHAR), count(DISTINCT user_id)
FROM g JOIN d ON d.day BETWEEN g - {days - 1} AND g GROUP BY g""" for name, days in (("dau", 1), ("wau", 7), ("mau", 30)))


@register("audience_overview", f"""
WITH d AS ({_user_days_sql()}),
g AS (SELECT CAST(unnest(generate_series(DATE '{PERIOD[0]}', DATE '{PERIOD[1]}', INTERVAL 1 DAY)) AS DATE) AS g)
{_DISTRIBUTIONS_SQL}
UNION ALL {_ACTIVE_SQL}
UNION ALL SELECT 'retention', CAST(birthday AS VARCHAR), CAST(day - birthday AS VARCHAR), count(*) FROM d
WHERE day <= DATE '{PERIOD[1]}' GROUP BY birthday, day""")
def q_audience_overview(spark, d):
    f, _ = load_events(spark, d)
    return overview.audience_overview(f, *PERIOD)


_INTERACTIONS_SQL = " UNION ALL ".join(f"""
SELECT '{x}' AS dimension, CAST(value AS VARCHAR) AS value, status, count(*) AS users
FROM (SELECT user_id, max(value) AS value, CASE WHEN count(DISTINCT status) = 2 THEN 'feed+messenger' ELSE min(status) END AS status
      FROM (SELECT user_id, {x} AS value, 'feed_only' AS status, time FROM feed_actions
            UNION ALL SELECT user_id, {x}, 'messenger_only', time FROM message_actions)
      WHERE CAST(time AS DATE) BETWEEN DATE '{WEEK[0]}' AND DATE '{WEEK[1]}' GROUP BY user_id)
GROUP BY value, status""" for x in overview.DIMS)


@register("interaction_by_dimensions", _INTERACTIONS_SQL)
def q_interaction_by_dimensions(spark, d):
    f, m = load_events(spark, d)
    return overview.interaction_by_dimensions(f, m, *WEEK)


@register("top_posts_sliced", f"""
SELECT post_id, count(*) FILTER (WHERE action = 'view') AS views, count(*) FILTER (WHERE action = 'like') AS likes,
       count(DISTINCT user_id) AS users, CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr
FROM feed_actions
WHERE gender = 1 AND country IN ('Russia', 'Belarus', 'Finland') AND source = 'organic'
  AND time >= TIMESTAMP '{WEEK[0]} 06:00:00' AND time < TIMESTAMP '{WEEK[1]} 18:00:00'
GROUP BY post_id ORDER BY likes DESC, post_id LIMIT 10""", doubles=("ctr",))
def q_top_posts_sliced(spark, d):
    f, _ = load_events(spark, d)
    return aud.top_posts(f, 10, "likes", gender=1, country=["Russia", "Belarus", "Finland"], source="organic",
                         time_from=f"{WEEK[0]} 06:00:00", time_to=f"{WEEK[1]} 18:00:00")


@register("live_offsets_sliced", f"""
WITH e AS (SELECT user_id, action, time_bucket(INTERVAL '15 minutes', time) AS slot, DATE '{Y}' - CAST(time AS DATE) AS back
           FROM feed_actions WHERE os = 'iOS' AND gender = 0 AND post_id BETWEEN 0 AND 49),
s AS (SELECT slot + to_days(CAST(back AS INTEGER)) AS ts, back, count(DISTINCT user_id) AS users,
             count(*) FILTER (WHERE action = 'view') AS views, count(*) FILTER (WHERE action = 'like') AS likes
      FROM e WHERE back IN (0, 1, 7) GROUP BY ALL)
SELECT ts, strftime(ts, '%H:%M') AS hm, {", ".join(
    f"CAST(coalesce(sum({m}) FILTER (WHERE back = {b}), 0) AS BIGINT) AS {m}{x}"
    for b, x in ((0, ""), (1, "_1d"), (7, "_7d")) for m in ("users", "views", "likes"))}
FROM s GROUP BY ts""")
def q_live_offsets_sliced(spark, d):
    f, _ = load_events(spark, d)
    return aud.live_offsets(aud.filter_slice(f, os="iOS", gender=0, post_id=list(range(50))), YESTERDAY, (1, 7))


@register("user_bubbles", """
SELECT COALESCE(f.user_id, m.user_id) AS user_id,
       CAST(COALESCE(f.views, 0) AS BIGINT) AS views, CAST(COALESCE(f.likes, 0) AS BIGINT) AS likes,
       CAST(COALESCE(m.messages, 0) AS BIGINT) AS messages
FROM (SELECT user_id, count(post_id) FILTER (WHERE action = 'view') AS views,
             count(post_id) FILTER (WHERE action = 'like') AS likes FROM feed_actions GROUP BY 1) f
FULL JOIN (SELECT user_id, count(reciever_id) AS messages FROM message_actions GROUP BY 1) m
  ON f.user_id = m.user_id""")
def q_user_bubbles(spark, d):
    f, m = load_events(spark, d)
    return aud.user_bubbles(f, m, *PERIOD)


def _drop_sql(day: str, base: str) -> str:
    return f"""
WITH f AS (SELECT user_id, CAST(time AS DATE) AS day, country, city, os, source,
                  CAST(hour(time) AS VARCHAR) AS hour
           FROM feed_actions WHERE CAST(time AS DATE) IN (DATE '{day}', DATE '{base}')),
m AS (SELECT DISTINCT user_id, day, 'country' AS dimension, country AS value FROM f
      UNION SELECT DISTINCT user_id, day, 'city', city FROM f
      UNION SELECT DISTINCT user_id, day, 'os', os FROM f
      UNION SELECT DISTINCT user_id, day, 'source', source FROM f
      UNION SELECT DISTINCT user_id, day, 'hour', hour FROM f),
agg AS (SELECT dimension, value, count(*) FILTER (WHERE day = DATE '{day}') AS users_day,
               count(*) FILTER (WHERE day = DATE '{base}') AS users_base FROM m GROUP BY 1, 2),
tot AS (SELECT count(DISTINCT user_id) FILTER (WHERE day = DATE '{day}')
             - count(DISTINCT user_id) FILTER (WHERE day = DATE '{base}') AS td FROM f)
SELECT dimension, value, users_day, users_base, users_day - users_base AS delta,
       CAST(users_day - users_base AS DOUBLE) / nullif(td, 0) AS share_of_total_delta,
       (users_day = 0 AND users_base > 0) AS vanished
FROM agg, tot"""


@register("metric_drop_by_dimension", _drop_sql(Y, (YESTERDAY - dt.timedelta(days=1)).isoformat()),
          doubles=("share_of_total_delta",))
def q_metric_drop_by_dimension(spark, d):
    f, _ = load_events(spark, d)
    return drivers.metric_drop_by_dimension(f, YESTERDAY, "day")


@register("metric_drop_by_dimension_week",
          _drop_sql(Y, (YESTERDAY - dt.timedelta(days=7)).isoformat()),
          doubles=("share_of_total_delta",))
def q_metric_drop_by_dimension_week(spark, d):
    f, _ = load_events(spark, d)
    return drivers.metric_drop_by_dimension(f, YESTERDAY, "week")
