"""User activity frames and the report metrics built on them.

The reference full-joins a feed aggregate with a messenger aggregate.  Here both
event tables are projected to the same narrow shape, unioned and aggregated
once: one shuffle on (user, grain), partial aggregation on the map side (so a
user holding a third of all rows still ships one row per map task), and no
outer-join null filling is needed because absent counters are simply 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions.metrics import ratio
from cohortia.functions.timefn import as_date, date_lit, day, hm, slot15

FEED_ONLY = "feed_only"
MESSENGER_ONLY = "messenger_only"
BOTH = "feed+messenger"


def _tagged(feed: DataFrame, messages: DataFrame, grain: Column, grain_name: str,
            where_feed: Column | None = None, where_msg: Column | None = None) -> DataFrame:
    f = feed if where_feed is None else feed.where(where_feed)
    m = messages if where_msg is None else messages.where(where_msg)
    f = f.select("user_id", grain.alias(grain_name),
                 F.when((F.col("action") == "view") & F.col("post_id").isNotNull(), 1)
                  .otherwise(0).alias("v"),
                 F.when((F.col("action") == "like") & F.col("post_id").isNotNull(), 1)
                  .otherwise(0).alias("l"),
                 F.lit(0).alias("m"))
    m = m.select("user_id", grain.alias(grain_name), F.lit(0).alias("v"), F.lit(0).alias("l"),
                 F.when(F.col("reciever_id").isNotNull(), 1).otherwise(0).alias("m"))
    return f.unionByName(m)


def _activity(tagged: DataFrame, grain_name: str) -> DataFrame:
    return (tagged.groupBy("user_id", grain_name)
            .agg(F.sum("v").cast("long").alias("views"),
                 F.sum("l").cast("long").alias("likes"),
                 F.sum("m").cast("long").alias("messages")))


def user_day_activity(feed: DataFrame, messages: DataFrame, start=None, end=None) -> DataFrame:
    """(user_id, day, views, likes, messages), counters 0-filled.

    ``start``/``end`` bound the day inclusively (P4/P5); both are pushed into
    each scan before the union.
    """
    cond = None
    if start is not None:
        cond = day() >= date_lit(start)
    if end is not None:
        c = day() <= date_lit(end)
        cond = c if cond is None else cond & c
    return _activity(_tagged(feed, messages, day(), "day", cond, cond), "day")


def user_slot_activity(feed: DataFrame, messages: DataFrame, on_day) -> DataFrame:
    """(user_id, mins_15, views, likes, messages) for one day."""
    cond = day() == date_lit(on_day)
    return _activity(_tagged(feed, messages, slot15(), "mins_15", cond, cond), "mins_15")


def service_status(views: str = "views", likes: str = "likes", messages: str = "messages") -> Column:
    """messenger_only / feed_only / feed+messenger (exclusive per user and grain)."""
    fe = F.col(views) + F.col(likes)
    return (F.when(F.col(messages) == 0, F.lit(FEED_ONLY))
            .when((F.col(messages) > 0) & (fe == 0), F.lit(MESSENGER_ONLY))
            .when((F.col(messages) > 0) & (fe > 0), F.lit(BOTH))
            .otherwise(F.lit(" ")))


def with_status(activity: DataFrame) -> DataFrame:
    return activity.withColumn("status", service_status())


def dau_by_status(activity: DataFrame, grain: str = "day") -> DataFrame:
    """C4: distinct users per grain, in total and by exclusive service status.

    ``activity`` has one row per (user, grain) so counting rows counts
    distinct users; the three status counts add up to the total.
    """
    st = service_status()
    return (activity.groupBy(grain)
            .agg(F.count(F.lit(1)).alias("dau"),
                 F.count_if(st == FEED_ONLY).alias("dau_feed_only"),
                 F.count_if(st == MESSENGER_ONLY).alias("dau_messenger_only"),
                 F.count_if(st == BOTH).alias("dau_feed_messenger")))


def event_totals(activity: DataFrame, grain: str = "day", label: str | None = None,
                 label_format: str = "HH-mm") -> DataFrame:
    """Total views, likes and messages per grain (day, or slot as 'HH-MM')."""
    key = F.col(grain) if label is None else F.date_format(grain, label_format).alias(label)
    return (activity.groupBy(key)
            .agg(F.sum("views").cast("long").alias("views"),
                 F.sum("likes").cast("long").alias("likes"),
                 F.sum("messages").cast("long").alias("messages")))


def avg_events_daily(activity: DataFrame) -> DataFrame:
    """C6 (history): per day, mean of each counter over user-days where it is > 0.

    One aggregation keyed by day replaces the reference's three frames glued
    by position (quirk D7).
    """
    return (activity.groupBy("day")
            .agg(F.avg(F.when(F.col("views") > 0, F.col("views"))).alias("views_avg"),
                 F.avg(F.when(F.col("likes") > 0, F.col("likes"))).alias("likes_avg"),
                 F.avg(F.when(F.col("messages") > 0, F.col("messages"))).alias("messages_avg")))


def avg_events_per_user(feed: DataFrame, messages: DataFrame, on_day) -> DataFrame:
    """C6 (yesterday): mean per-user total of each counter over users with a positive total."""
    a = user_day_activity(feed, messages, on_day, on_day)
    return (a.agg(F.avg(F.when(F.col("views") > 0, F.col("views"))).alias("views_avg"),
                  F.avg(F.when(F.col("likes") > 0, F.col("likes"))).alias("likes_avg"),
                  F.avg(F.when(F.col("messages") > 0, F.col("messages"))).alias("messages_avg"))
             .select(date_lit(on_day).alias("day"), "*"))


def _user_days(feed: DataFrame, messages: DataFrame, end=None) -> DataFrame:
    f = feed.select("user_id", day().alias("day"))
    m = messages.select("user_id", day().alias("day"))
    if end is not None:
        f = f.where(F.col("day") <= date_lit(end))
        m = m.where(F.col("day") <= date_lit(end))
    return f.unionByName(m)


def new_users_on(feed: DataFrame, messages: DataFrame, on_day) -> DataFrame:
    """Users active on ``on_day`` in either service and never before in either.

    Equivalent to the reference's (FULL JOIN of the day) NOT IN (FULL JOIN of
    the history), computed as one aggregation: first day over both == on_day.
    """
    d = as_date(on_day)
    return (_user_days(feed, messages, d).groupBy("user_id")
            .agg(F.min("day").alias("first_day"))
            .where(F.col("first_day") == date_lit(d))
            .select("user_id"))


def new_users_daily(activity: DataFrame) -> DataFrame:
    """New users per first day, split by the status on that first day."""
    first = (with_status(activity).groupBy("user_id")
             .agg(F.min("day").alias("birthday"),
                  F.min_by("status", "day").alias("status")))
    return first.groupBy("birthday", "status").agg(F.count(F.lit(1)).alias("new_users"))


def feed_daily_report(feed: DataFrame, as_of, days: int = 7) -> DataFrame:
    """DAU, views, likes and CTR (%) for the ``days`` complete days before ``as_of``."""
    d = as_date(as_of)
    f = feed.where(day().between(F.date_sub(date_lit(d), days), F.date_sub(date_lit(d), 1)))
    views = F.count_if((F.col("action") == "view") & F.col("user_id").isNotNull())
    likes = F.count_if((F.col("action") == "like") & F.col("user_id").isNotNull())
    return (f.groupBy(day().alias("day"))
            .agg(F.countDistinct("user_id").alias("dau"), views.alias("views"),
                 likes.alias("likes"), (ratio(likes, views) * 100).alias("ctr")))


def slot_labels(col: str = "mins_15") -> Column:
    return hm(col)


def second_largest(df: DataFrame, col: str):
    """P17 compat: the second-largest value of ``col`` (the reference's "last complete
    day" = second-newest day present) as a scalar-subquery Column."""
    top = df.select(F.max(col)).scalar()
    return df.where(F.col(col) < top).select(F.max(col)).scalar()


def latest_rows(df: DataFrame, col: str = "day") -> DataFrame:
    """Rows whose ``col`` equals its maximum (``df[df.day == df.day.max()]``)."""
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def dau_on_last_complete_day(activity: DataFrame) -> DataFrame:
    """C4 with the reference's day pick: status DAU of the second-newest day present."""
    d = second_largest(activity, "day")
    return dau_by_status(activity.where(F.col("day") == d), "day")
