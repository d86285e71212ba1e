"""Registered exploratory-statistics queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortia.operators import eda
from cohortia.operators import experiment as ex
from cohortia.plans.catalog import register
from cohortia.sources.events import load_events

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 30)

_POSTS = """
SELECT post_id, count(*) FILTER (WHERE action = 'like') AS likes,
       count(*) FILTER (WHERE action = 'view') AS views
FROM feed_actions GROUP BY post_id"""

_POST_STATS = """
SELECT post_id, count(*) FILTER (WHERE action = 'like') AS likes,
       count(*) FILTER (WHERE action = 'view') AS views,
       CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr,
       min(time) AS start_date, max(time) AS end_date,
       CAST(epoch_us(max(time)) // 1000000 - epoch_us(min(time)) // 1000000 AS BIGINT) AS lifetime_sec
FROM feed_actions GROUP BY post_id"""


def _posts(spark, d):
    f, _ = load_events(spark, d)
    return f


@register("posts_views_likes", _POSTS)
def q_posts_views_likes(spark, d):
    return eda.posts_views_likes(_posts(spark, d))


@register("post_stats", _POST_STATS, doubles=("ctr",))
def q_post_stats(spark, d):
    return eda.post_stats(_posts(spark, d))


@register("lifetime_summary", f"""
SELECT avg(lifetime_sec) AS mean_lifetime_sec, avg(lifetime_sec) / 3600 AS mean_lifetime_hours,
       avg(lifetime_sec) / 86400 AS mean_lifetime_days FROM ({_POST_STATS}) p""",
          doubles=("mean_lifetime_sec", "mean_lifetime_hours", "mean_lifetime_days"))
def q_lifetime_summary(spark, d):
    return eda.lifetime_summary(eda.post_stats(_posts(spark, d)))


_DAILY = """
SELECT CAST(time AS DATE) AS day, count(*) FILTER (WHERE action = 'view') AS views,
       count(*) FILTER (WHERE action = 'like') AS likes FROM feed_actions GROUP BY 1"""


@register("daily_views_likes", _DAILY)
def q_daily_views_likes(spark, d):
    return eda.daily_views_likes(_posts(spark, d))


@register("central_tendency", f"""
SELECT avg(views) AS views_mean, median(views) AS views_median,
       avg(likes) AS likes_mean, median(likes) AS likes_median FROM ({_DAILY}) d""",
          doubles=("views_mean", "views_median", "likes_mean", "likes_median"))
def q_central_tendency(spark, d):
    return eda.central_tendency(eda.daily_views_likes(_posts(spark, d)))


@register("daily_users", """
SELECT CAST(time AS DATE) AS day, count(DISTINCT user_id) AS num_of_users FROM feed_actions GROUP BY 1""")
def q_daily_users(spark, d):
    return eda.daily_users(_posts(spark, d))


@register("daily_unique_posts", """
SELECT CAST(time AS DATE) AS day, count(DISTINCT post_id) AS posts FROM feed_actions GROUP BY 1""")
def q_daily_unique_posts(spark, d):
    return eda.daily_unique_posts(_posts(spark, d))


_HOURLY = """
SELECT date_trunc('hour', time) AS day_h, count(user_id) AS actions FROM feed_actions GROUP BY 1"""


@register("hourly_activity", _HOURLY)
def q_hourly_activity(spark, d):
    return eda.hourly_activity(_posts(spark, d))


@register("hour_profile", """
SELECT CAST(time AS DATE) AS day, CAST(hour(time) AS INTEGER) AS hour, count(user_id) AS actions
FROM feed_actions GROUP BY 1, 2""")
def q_hour_profile(spark, d):
    return eda.hour_profile(_posts(spark, d))


@register("publication_hour_profile", """
SELECT CAST(hour(publication_time) AS INTEGER) AS hour, count(DISTINCT post_id) AS posts
FROM (SELECT post_id, min(date_trunc('hour', time)) AS publication_time FROM feed_actions GROUP BY 1) p
GROUP BY 1""")
def q_publication_hour_profile(spark, d):
    return eda.publication_hour_profile(_posts(spark, d))


def _users_sql() -> str:
    from cohortia.plans.q_experiment import _users_sql as us
    return us((1, 2))


@register("describe_by_group", f"""
SELECT exp_group, count(ctr) AS count, avg(ctr) AS mean, stddev_samp(ctr) AS std,
       CAST(min(ctr) AS DOUBLE) AS min, quantile_cont(ctr, 0.25) AS q25, quantile_cont(ctr, 0.5) AS q50,
       quantile_cont(ctr, 0.75) AS q75, CAST(max(ctr) AS DOUBLE) AS max
FROM ({_users_sql()}) u WHERE ctr IS NOT NULL GROUP BY exp_group""",
          doubles=("mean", "std", "min", "q25", "q50", "q75", "max"))
def q_describe_by_group(spark, d):
    u = ex.experiment_user_metrics(_posts(spark, d), START, END, (1, 2))
    return eda.describe_by_group(u, "ctr", ("exp_group",))


@register("describe_views_per_post", f"""
SELECT count(views) AS count, avg(views) AS mean, stddev_samp(views) AS std,
       CAST(min(views) AS DOUBLE) AS min, quantile_cont(views, 0.25) AS q25,
       quantile_cont(views, 0.5) AS q50, quantile_cont(views, 0.75) AS q75,
       CAST(max(views) AS DOUBLE) AS max
FROM ({_POSTS}) p""", doubles=("mean", "std", "min", "q25", "q50", "q75", "max"))
def q_describe_views_per_post(spark, d):
    return eda.describe_by_group(eda.posts_views_likes(_posts(spark, d)), "views")


@register("skewness", f"""
WITH p AS ({_POSTS}),
m AS (SELECT avg(views) AS mv, avg(likes) AS ml FROM p)
SELECT 'views' AS "column", avg(power(views - mv, 3)) / power(avg(power(views - mv, 2)), 1.5) AS skewness FROM p, m
UNION ALL
SELECT 'likes', avg(power(likes - ml, 3)) / power(avg(power(likes - ml, 2)), 1.5) FROM p, m""",
          doubles=("skewness",))
def q_skewness(spark, d):
    return eda.skewness(eda.posts_views_likes(_posts(spark, d)), ["views", "likes"])


@register("zscore", f"""
WITH p AS ({_POSTS})
SELECT *, (views - (SELECT avg(views) FROM p)) / (SELECT stddev_samp(views) FROM p) AS views_z,
          (likes - (SELECT avg(likes) FROM p)) / (SELECT stddev_samp(likes) FROM p) AS likes_z
FROM p""", doubles=("views_z", "likes_z"))
def q_zscore(spark, d):
    return eda.zscore(eda.posts_views_likes(_posts(spark, d)), ["views", "likes"])


@register("histogram", f"""
WITH u AS (SELECT exp_group, ctr AS v FROM ({_users_sql()}) x WHERE ctr IS NOT NULL),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM u)
SELECT exp_group, bin, lo + bin * ((hi - lo) / 20) AS lo, lo + (bin + 1) * ((hi - lo) / 20) AS hi, n
FROM (SELECT exp_group,
             CAST(least(coalesce(floor((v - lo) / nullif(hi - lo, 0) * 20), 0), 19) AS INTEGER) AS bin,
             count(*) AS n
      FROM u, r GROUP BY 1, 2) h, r""", doubles=("lo", "hi"))
def q_histogram(spark, d):
    u = ex.experiment_user_metrics(_posts(spark, d), START, END, (1, 2))
    return eda.histogram(u, "ctr", 20, ("exp_group",))


@register("kde_curve", f"""
WITH d AS (SELECT CAST(views AS DOUBLE) AS v FROM ({_POSTS}) p WHERE views IS NOT NULL),
st AS (SELECT CAST(count(*) AS DOUBLE) AS n, min(v) AS lo, max(v) AS hi,
              stddev_samp(v) * power(CAST(count(*) AS DOUBLE), -0.2) AS h FROM d),
b AS (SELECT CAST(least(coalesce(floor((v - lo) / nullif(hi - lo, 0) * 1024), 0), 1023) AS INTEGER) AS bin,
             count(*) AS c FROM d, st GROUP BY 1),
pts AS (SELECT b.c, st.n, st.h, st.lo + (b.bin + 0.5) * ((st.hi - st.lo) / 1024) AS centre,
               st.lo - 3.0 * st.h + i.range * ((st.hi - st.lo + 2 * 3.0 * st.h) / 199) AS x, i.range AS i
        FROM b, st, range(0, 200) i)
SELECT i, first(x) AS x, sum(c * exp(-0.5 * ((x - centre) / h) * ((x - centre) / h)) / (n * h * sqrt(2 * pi()))) AS density
FROM pts GROUP BY i""", doubles=("x", "density"))
def q_kde_curve(spark, d):
    return eda.kde_curve(eda.posts_views_likes(_posts(spark, d)), "views", 200, 1024)


_PAIR_COLS = ["ctr", "lifetime_sec", "views", "likes"]


def _pair_bins_sql(bins: int = 20) -> str:
    cols = _PAIR_COLS
    rng = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in cols)

    def b(c):
        return (f"CAST(least(coalesce(floor((CAST({c} AS DOUBLE) - lo_{c}) / nullif(hi_{c} - lo_{c}, 0) * {bins}), 0),"
                f" {bins - 1}) AS INTEGER)")
    parts = []
    for i, a in enumerate(cols):
        for c in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS x_col, '{c}' AS y_col, {b(a)} AS x_bin, {b(c)} AS y_bin FROM p, r")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"""
WITH p0 AS ({_POST_STATS}), r AS (SELECT {rng} FROM p0),
p AS (SELECT * FROM p0 WHERE {nn})
SELECT x_col, y_col, x_bin, y_bin, count(*) AS n FROM (
{' UNION ALL '.join(parts)}) t GROUP BY 1, 2, 3, 4"""


@register("pair_bins", _pair_bins_sql())
def q_pair_bins(spark, d):
    return eda.pair_bins(eda.post_stats(_posts(spark, d)), _PAIR_COLS, 20)


def _qq_sql(n: int = 101) -> str:
    probs = ", ".join(repr(i / (n - 1)) for i in range(n))
    return f"""
WITH p AS ({_POSTS}),
z AS (SELECT (views - (SELECT avg(views) FROM p)) / (SELECT stddev_samp(views) FROM p) AS vz,
             (likes - (SELECT avg(likes) FROM p)) / (SELECT stddev_samp(likes) FROM p) AS lz FROM p),
q AS (SELECT quantile_cont(vz, [{probs}]) AS xq, quantile_cont(lz, [{probs}]) AS yq FROM z),
pr AS (SELECT CAST(unnest([{probs}]) AS DOUBLE) AS prob, unnest(generate_series(1, {n})) AS k)
SELECT pr.prob, q.xq[pr.k] AS x_q, q.yq[pr.k] AS y_q FROM pr, q"""


@register("qq_points", _qq_sql(), doubles=("prob", "x_q", "y_q"))
def q_qq_points(spark, d):
    return eda.qq_points(eda.posts_views_likes(_posts(spark, d)), "views", "likes", 101)


@register("seasonal_decompose", f"""
WITH s AS ({_HOURLY}),
cal AS (SELECT unnest(generate_series((SELECT min(day_h) FROM s), (SELECT max(day_h) FROM s),
                                      INTERVAL 1 HOUR)) AS day_h),
d AS (SELECT cal.day_h, CAST(coalesce(s.actions, 0) AS DOUBLE) AS observed
      FROM cal LEFT JOIN s ON cal.day_h = s.day_h),
t AS (SELECT *, CASE WHEN count(observed) OVER w = 25 THEN
              (sum(observed) OVER w - 0.5 * lag(observed, 12) OVER o - 0.5 * lead(observed, 12) OVER o) / 24
            END AS trend, hour(day_h) AS hod
      FROM d WINDOW w AS (ORDER BY day_h ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING), o AS (ORDER BY day_h)),
i AS (SELECT hod, avg(observed - trend) AS s0 FROM t GROUP BY hod),
i2 AS (SELECT hod, s0 - avg(s0) OVER () AS seasonal FROM i)
SELECT t.day_h, t.observed, t.trend, i2.seasonal, t.observed - t.trend - i2.seasonal AS resid
FROM t JOIN i2 ON t.hod = i2.hod""", doubles=("observed", "trend", "seasonal", "resid"))
def q_seasonal_decompose(spark, d):
    return eda.seasonal_decompose(eda.hourly_activity(_posts(spark, d)), "day_h", "actions")


def _robust_sql(key: str, inner: int = 2, robust_rounds: int = 2) -> str:
    """The rounds of the robust decomposition as a chain of tables, one local regression each."""
    def line(y: str, w: str) -> str:        # regr by moments about the row itself
        m = {n: f"sum({v}) OVER {w}" for n, v in (("s0", "weight"), ("s1", "weight * t"), ("s2", "weight * t * t"),
                                                  ("b0", f"weight * ({y})"), ("b1", f"weight * t * ({y})"))}
        return "SELECT *, " + ", ".join(f"{v} AS {n}" for n, v in m.items()) + f", avg({y}) OVER {w} AS plain"

    at = """CASE WHEN s0 * (s2 - 2 * t * s1 + t * t * s0) - (s1 - t * s0) * (s1 - t * s0) > 1e-6 * s0 * s0
        THEN ((s2 - 2 * t * s1 + t * t * s0) * b0 - (s1 - t * s0) * (b1 - t * b0))
             / (s0 * (s2 - 2 * t * s1 + t * t * s0) - (s1 - t * s0) * (s1 - t * s0))
        ELSE coalesce(b0 / nullif(s0, 0), plain) END"""
    steps, last = [], "x0"
    for k in range(1, (robust_rounds + 1) * inner + 1):
        steps.append(f"""
t{k} AS (SELECT k, h, t, c, observed, weight, seasonal, {at} AS trend FROM ({line('observed - seasonal', 'w')} FROM {last}
    WINDOW w AS (PARTITION BY k ORDER BY t ROWS BETWEEN 24 PRECEDING AND 24 FOLLOWING))),
s{k} AS (SELECT k, h, t, c, observed, weight, trend, {at} AS s FROM ({line('observed - trend', 'w')} FROM t{k}
    WINDOW w AS (PARTITION BY k, t % 24 ORDER BY t ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING))),
x{k} AS MATERIALIZED (SELECT k, h, t, c, observed, weight, trend, s - avg(s) OVER (PARTITION BY k, c) AS seasonal FROM s{k})""")
        last = f"x{k}"
        if k % inner == 0 and k < (robust_rounds + 1) * inner:
            steps.append(f"""
w{k} AS MATERIALIZED (SELECT x.* REPLACE (CASE WHEN m = 0 THEN CAST(observed = trend + seasonal AS DOUBLE)
        WHEN abs(observed - trend - seasonal) < m THEN power(1 - power(abs(observed - trend - seasonal) / m, 2), 2) ELSE 0.0 END AS weight)
    FROM {last} x JOIN (SELECT k, 6 * median(abs(observed - trend - seasonal)) AS m FROM {last} GROUP BY k) USING (k))""")
            last = f"w{k}"
    return f"""
WITH e AS (SELECT {key} AS k, date_trunc('hour', time) AS h, count(user_id) AS n FROM feed_actions GROUP BY 1, 2),
cal AS (SELECT k, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM e GROUP BY k),
x0 AS MATERIALIZED (SELECT cal.k, cal.h, CAST(row_number() OVER (PARTITION BY cal.k ORDER BY cal.h) - 1 AS DOUBLE) AS t,
       least((row_number() OVER (PARTITION BY cal.k ORDER BY cal.h) - 1) // 24, greatest(count(*) OVER (PARTITION BY cal.k) // 24 - 1, 0)) AS c,
       CAST(coalesce(n, 0) AS DOUBLE) AS observed, 0.0::DOUBLE AS seasonal, 1.0::DOUBLE AS weight
       FROM cal LEFT JOIN e ON cal.k = e.k AND cal.h = e.h),{','.join(steps)}
SELECT k AS {key}, h AS day_h, observed, trend, seasonal, observed - trend - seasonal AS resid, weight FROM {last}"""


@register("seasonal_decompose_robust", _robust_sql("country"), doubles=("observed", "trend", "seasonal", "resid", "weight"))
def q_seasonal_decompose_robust(spark, d):
    f = _posts(spark, d)
    hourly = f.groupBy("country", F.date_trunc("hour", "time").alias("day_h")).agg(F.count("user_id").alias("actions"))
    return eda.robust_decompose(hourly, "day_h", "actions", ("country",))


@register("preview_events")
def q_preview_events(spark, d):
    """S3: ``SELECT * … LIMIT 5`` over the feed (the limit is the feature; no oracle
    because LIMIT without ORDER BY picks arbitrary rows)."""
    from cohortia.sources.tables import preview
    return preview(_posts(spark, d), 5).select("user_id", "post_id", "action", "time",
                                               F.lit(5).alias("limit"))


@register("latest_events", """
SELECT user_id, post_id, action, time FROM feed_actions
ORDER BY time DESC, user_id, post_id, action LIMIT 100""")
def q_latest_events(spark, d):
    """The last 100 actions, newest first."""
    from cohortia.sources.events import load_events
    from cohortia.sources.tables import preview
    f, _ = load_events(spark, d)
    return preview(f.select("user_id", "post_id", "action", "time"), 100, (F.col("time").desc(), "user_id", "post_id", "action"))


def _kendall_sql(cols: list[str]) -> str:
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            s = f"""
SELECT '{a}' AS x_col, '{b}' AS y_col,
       (SELECT count(*) FROM p WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n,
       sum(sign(l.x - r.x) * sign(l.y - r.y)) / sqrt(count(*) FILTER (WHERE l.x <> r.x)
                                                    * count(*) FILTER (WHERE l.y <> r.y)) AS tau
FROM (SELECT post_id, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM p
      WHERE {a} IS NOT NULL AND {b} IS NOT NULL) l
JOIN (SELECT post_id, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM p
      WHERE {a} IS NOT NULL AND {b} IS NOT NULL) r ON l.post_id < r.post_id"""
            parts.append(s)
    body = "\nUNION ALL\n".join(parts)
    diag = "\nUNION ALL\n".join(f"SELECT '{c}', '{c}', count({c}), 1.0::DOUBLE FROM p" for c in cols)
    return f"""
WITH p AS ({_POST_STATS}),
t AS ({body})
SELECT x_col, y_col, n, tau FROM t
UNION ALL SELECT y_col, x_col, n, tau FROM t
UNION ALL {diag}"""


@register("kendall_matrix", _kendall_sql(_PAIR_COLS), doubles=("tau",))
def q_kendall_matrix(spark, d):
    """A15/T11 over post stats; the oracle is a brute-force pair join (fine for
    100 posts in SQL), the Spark plan never forms pairs."""
    return eda.kendall_matrix(eda.post_stats(_posts(spark, d)), _PAIR_COLS)
