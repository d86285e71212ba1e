"""Audience dashboard operators.

DAU/WAU/MAU use *coverage spans* instead of a distinct count per sliding
window (``count(DISTINCT) OVER`` does not exist in Spark): per user, each active
day covers the following horizon−1 days up to the next active day, so every
(user, as-of day) pair is generated exactly once and a plain count per day is
the distinct count.  The spans come from each user's sorted set of active days
(one aggregation keyed by user, bounded by the calendar).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.metrics import ratio
from cohortia.functions.timefn import as_date, date_lit, day, hm, on_days, slot15
from cohortia.session import materialize


def filter_slice(df: DataFrame, **dims) -> DataFrame:
    """Dashboard slicers — ``filter_slice(feed, source='ads', gender=1)``.

    A list value means IN; ``time_from``/``time_to`` bound the event time.
    """
    for k, v in dims.items():
        if v is None:
            continue
        if k == "time_from":
            df = df.where(F.col("time") >= F.lit(v).cast("timestamp"))
        elif k == "time_to":
            df = df.where(F.col("time") < F.lit(v).cast("timestamp"))
        elif isinstance(v, (list, tuple, set)):
            df = df.where(F.col(k).isin(*list(v)))
        else:
            df = df.where(F.col(k) == F.lit(v))
    return df


def wau_mau_stickiness(events: DataFrame, start, end) -> DataFrame:
    """Per day in [start, end]: dau, wau (7 days), mau (30 days), stickiness = dau/mau."""
    s, e = as_date(start), as_date(end)
    days = (events.where(day().between(date_lit(s - _dt.timedelta(days=29)), date_lit(e)))
            .groupBy("user_id").agg(F.array_sort(F.collect_set(day())).alias("days")))
    n = F.size("days")
    # each active day covers the as-of days up to the next active day (at most 30)
    spans = F.transform("days", lambda dd, i: F.struct(
        dd.alias("day"),
        F.least(F.date_add(dd, 29), date_lit(e),
                F.coalesce(F.when(i < n - 1, F.date_sub(F.element_at("days", i + 2), 1)),
                           F.date_add(dd, 29))).alias("span_end")))
    cov = (days.select(F.explode(spans).alias("sp"))
           .select(F.col("sp.day").alias("day"),
                   F.explode(F.sequence("sp.day", "sp.span_end")).alias("as_of_day"))
           .where(F.col("as_of_day") >= date_lit(s)))
    dist = F.datediff("as_of_day", "day")
    out = (cov.groupBy(F.col("as_of_day").alias("day"))
           .agg(F.count_if(dist == 0).alias("dau"), F.count_if(dist <= 6).alias("wau"),
                F.count(F.lit(1)).alias("mau")))
    return out.withColumn("stickiness", ratio("dau", "mau"))


def audience_distribution(events: DataFrame, dim: str, start=None, end=None) -> DataFrame:
    """Distinct users per value of ``dim`` and their share of all users."""
    ev = events
    if start is not None:
        ev = ev.where(day() >= date_lit(start))
    if end is not None:
        ev = ev.where(day() <= date_lit(end))
    # one pass: rollup gives per-value and overall distinct users together; written once, as
    # the values read the overall row
    r = materialize(ev.rollup(F.col(dim).alias("value"))
                    .agg(F.countDistinct("user_id").alias("users"), F.grouping_id().alias("_g")))
    total = r.where(F.col("_g") == 1).select("users").scalar()
    return r.where(F.col("_g") == 0).select(
        F.lit(dim).alias("dimension"), "value", "users", F.try_divide(F.col("users").cast("double"), total).alias("share"))


def kpi_card(feed: DataFrame, on_day) -> DataFrame:
    """Total users, posts, views, likes, CTR, average views/likes per user and
    1-day retention (share of the previous day's users active again on the day).

    One pass over the two days: grouping sets give per-user rows (activity flags
    and today's counts) and per-post rows (seen today) from the same scan; one
    global aggregation over those rows builds the card.
    """
    d = as_date(on_day)
    prev = d - _dt.timedelta(days=1)
    f = feed.where(day().between(date_lit(prev), date_lit(d))).select(
        "user_id", "post_id", "action", (day() == date_lit(d)).alias("today"))
    g = (f.groupingSets([["user_id"], ["post_id"]], "user_id", "post_id")
         .agg(F.grouping_id().alias("gid"),
              F.max(F.col("today").cast("int")).alias("on_day"),
              F.max((~F.col("today")).cast("int")).alias("on_prev"),
              F.count_if(F.col("today") & (F.col("action") == "view")).alias("v"),
              F.count_if(F.col("today") & (F.col("action") == "like")).alias("l")))
    is_user, is_post = F.col("gid") == 1, F.col("gid") == 2      # post_id / user_id rolled up
    users = F.count_if(is_user & (F.col("on_day") == 1))
    views = F.sum(F.when(is_user, F.col("v")))
    likes = F.sum(F.when(is_user, F.col("l")))
    return g.agg(
        users.alias("users"), F.count_if(is_post & (F.col("on_day") == 1)).alias("posts"),
        views.cast("long").alias("views"), likes.cast("long").alias("likes"),
        ratio(likes, views).alias("ctr"), ratio(views, users).alias("avg_views"),
        ratio(likes, users).alias("avg_likes"),
        F.try_divide(F.count_if(is_user & (F.col("on_day") == 1) & (F.col("on_prev") == 1)).cast("double"),
                     F.count_if(is_user & (F.col("on_prev") == 1)).cast("double")).alias("retention_1d")
    ).select(date_lit(d).alias("day"), "*")


def top_posts(feed: DataFrame, k: int = 10, by: str = "views", **slicers) -> DataFrame:
    """The k posts with most ``by`` (views or likes), ties broken by post_id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its local top k, so only k rows per task move.
    """
    f = filter_slice(feed, **slicers)
    per = f.groupBy("post_id").agg(F.count_if(F.col("action") == "view").alias("views"),
                                   F.count_if(F.col("action") == "like").alias("likes"),
                                   F.countDistinct("user_id").alias("users"))
    per = per.withColumn("ctr", ratio("likes", "views"))
    return per.orderBy(F.col(by).desc(), F.col("post_id")).limit(k)


def top_users(feed: DataFrame, k: int = 10, by: str = "views", **slicers) -> DataFrame:
    """The k most active users (by views or likes), ties broken by user_id."""
    f = filter_slice(feed, **slicers)
    per = f.groupBy("user_id").agg(F.count_if(F.col("action") == "view").alias("views"),
                                   F.count_if(F.col("action") == "like").alias("likes"),
                                   F.countDistinct("post_id").alias("posts"))
    return per.orderBy(F.col(by).desc(), F.col("user_id")).limit(k)


def live_offsets(feed: DataFrame, on_day, offsets: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Per 15-minute slot of ``on_day``: users, views, likes, and the same
    metrics at the same slot ``o`` days earlier for each offset ``o``.

    Each event is assigned to the slot of ``on_day`` it is compared with (its
    own slot shifted forward by 0 or o days), so one aggregation produces all
    columns — no self join, and slots missing on either day stay aligned.
    """
    d = as_date(on_day)
    shifts = (0,) + tuple(offsets)
    days = [d - _dt.timedelta(days=o) for o in shifts]
    f = feed.where(on_days("time", *days)).select(
        "user_id", "action", slot15().alias("slot"),
        F.datediff(date_lit(d), day()).alias("shift"))
    f = f.where(F.col("shift").isin(*shifts))
    target = F.timestamp_add("DAY", F.col("shift"), F.col("slot")).alias("ts")
    agg = (f.groupBy(target, "shift")
           .agg(F.countDistinct("user_id").alias("users"),
                F.count_if(F.col("action") == "view").alias("views"),
                F.count_if(F.col("action") == "like").alias("likes")))
    cols = []
    for o in shifts:
        sfx = "" if o == 0 else f"_{o}d"
        for m in ("users", "views", "likes"):
            cols.append(F.coalesce(F.max(F.when(F.col("shift") == o, F.col(m))), F.lit(0))
                        .cast("long").alias(m + sfx))
    return agg.groupBy("ts").agg(*cols).select("ts", hm("ts").alias("hm"), *[
        c for c in [f"{m}{'' if o == 0 else f'_{o}d'}" for o in shifts
                    for m in ("users", "views", "likes")]])


def interaction_audience(feed: DataFrame, messages: DataFrame, dim: str, start, end) -> DataFrame:
    """Users per (value of ``dim``, service status) over [start, end].

    A user's status over the period: feed_only / messenger_only / feed+messenger;
    the dimension value is the user's MAX over both services.
    """
    s, e = as_date(start), as_date(end)
    cond = day().between(date_lit(s), date_lit(e))
    f = feed.where(cond).select("user_id", F.col(dim).alias("value"),
                                F.lit(1).alias("fe"), F.lit(0).alias("me"))
    m = messages.where(cond).select("user_id", F.col(dim).alias("value"),
                                    F.lit(0).alias("fe"), F.lit(1).alias("me"))
    u = (f.unionByName(m).groupBy("user_id")
         .agg(F.max("value").alias("value"), F.max("fe").alias("fe"), F.max("me").alias("me")))
    status = (F.when((F.col("fe") == 1) & (F.col("me") == 1), F.lit("feed+messenger"))
              .when(F.col("fe") == 1, F.lit("feed_only")).otherwise(F.lit("messenger_only")))
    return (u.groupBy(F.lit(dim).alias("dimension"), F.col("value").cast("string").alias("value"),
                      status.alias("status"))
            .agg(F.count(F.lit(1)).alias("users")))


def user_bubbles(feed: DataFrame, messages: DataFrame, start, end) -> DataFrame:
    """C19 bubble chart data: per user, views, likes and messages over the period."""
    from cohortia.operators.activity import user_day_activity
    a = user_day_activity(feed, messages, start, end)
    return a.groupBy("user_id").agg(F.sum("views").cast("long").alias("views"),
                                    F.sum("likes").cast("long").alias("likes"),
                                    F.sum("messages").cast("long").alias("messages"))
