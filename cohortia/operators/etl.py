"""Daily ETL: extract, merge, slice and fact table.

One Spark job replaces the scheduler's six tasks: both extracts are lazy
aggregations of one day (the date filter reaches the scans), the merge is an
inner equi-join on the user-day key, and the three slices come from one
aggregation over a melted (dimension, value) column instead of three passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.timefn import date_lit, day
from cohortia.session import materialize

METRICS = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]
DIMS = ["gender", "age", "os"]


def etl_feed_extract(feed: DataFrame, on_day, view_action: str = "view") -> DataFrame:
    """(event_date, user, gender, age, os, likes, views) for one day.

    ``view_action='views'`` reproduces the reference literal that never matches
    (quirk D6: views always 0).
    """
    f = feed.where(day() == date_lit(on_day))
    return (f.groupBy(day().alias("event_date"), F.col("user_id").alias("user"), *DIMS)
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == view_action).alias("views")))


def etl_messenger_extract(messages: DataFrame, on_day, attribution: str = "receiver") -> DataFrame:
    """(event_date, user, gender, age, os, messages_sent, messages_received,
    users_sent, users_received) for one day.

    ``attribution='receiver'`` (default): one pass over the day's messages —
    every message becomes a sender row and a receiver row, and one aggregation
    keyed by (event_date, user) counts both directions (the distinct counts
    are split by Spark's distinct-aggregation rewrite, so a hot receiver is
    spread over its senders).  gender/age/os are the user's own, known from the
    rows the user sent; a receive-only user gets NULL and takes the feed's
    attributes in ``etl_merge``.
    ``attribution='sender_groups'`` reproduces the reference (quirks D4/D5):
    received counts grouped by the *sender's* attributes, full join on user
    only, key columns taken from the sent side with ClickHouse defaults.
    """
    m = messages.where(day() == date_lit(on_day))
    if attribution == "sender_groups":
        # one pass: sender rows and receiver rows, both keyed with the *sender's* attributes
        tagged = F.explode(F.array(
            F.struct(F.lit(True).alias("sender"), F.col("user_id").alias("user"),
                     F.col("reciever_id").alias("peer")),
            F.struct(F.lit(False).alias("sender"), F.col("reciever_id").alias("user"),
                     F.col("user_id").alias("peer"))))
        # written once: both sides of the compat join read it (filters on ``sender``
        # would otherwise be pushed below the aggregation and split it into two scans)
        agg = materialize(m.select(day().alias("event_date"), *DIMS, tagged.alias("t"))
                          .select("event_date", *DIMS, "t.*")
                          .groupBy("sender", "event_date", "user", *DIMS)
                          .agg(F.count("peer").alias("n"), F.countDistinct("peer").alias("u")))
        sent = agg.where("sender").select("event_date", "user", *DIMS, F.col("n").alias("messages_sent"),
                                          F.col("u").alias("users_sent"))
        rec = agg.where(~F.col("sender") & F.col("user").isNotNull()).select(
            F.col("user").alias("r_user"), F.col("n").alias("messages_received"),
            F.col("u").alias("users_received"))
        j = sent.join(rec, sent["user"] == rec["r_user"], "full")
        return j.select(
            F.coalesce("event_date", F.lit("1970-01-01").cast("date")).alias("event_date"),
            F.coalesce("user", F.lit(0).cast("long")).alias("user"),
            F.coalesce("gender", F.lit(0)).alias("gender"), F.coalesce("age", F.lit(0)).alias("age"),
            F.coalesce("os", F.lit("")).alias("os"),
            *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in
              ("messages_sent", "messages_received", "users_sent", "users_received")])
    if attribution != "receiver":
        raise ValueError(attribution)
    roles = F.explode(F.array(
        F.struct(F.col("user_id").alias("user"), F.lit(True).alias("sender"),
                 F.col("reciever_id").alias("peer"), *[F.col(c).alias(c) for c in DIMS]),
        F.struct(F.col("reciever_id").alias("user"), F.lit(False).alias("sender"),
                 F.col("user_id").alias("peer"), F.lit(None).cast("int").alias("gender"),
                 F.lit(None).cast("int").alias("age"), F.lit(None).cast("string").alias("os"))))
    x = (m.select(day().alias("event_date"), roles.alias("r")).select("event_date", "r.*")
         .where(F.col("user").isNotNull()))
    snd, rcv = F.col("sender"), ~F.col("sender")
    return (x.groupBy("event_date", "user")
            .agg(*[F.max(F.when(snd, F.col(c))).alias(c) for c in DIMS],
                 F.count(F.when(snd, F.col("peer"))).alias("messages_sent"),
                 F.count(F.when(rcv, F.col("peer"))).alias("messages_received"),
                 F.countDistinct(F.when(snd, F.col("peer"))).alias("users_sent"),
                 F.countDistinct(F.when(rcv, F.col("peer"))).alias("users_received")))


def etl_merge(feed_x: DataFrame, msg_x: DataFrame) -> DataFrame:
    """The reference's outer merge on (user, event_date, gender, age, os) followed
    by dropna keeps the keys present on both sides — an inner equi-join on
    (user, event_date) whose messenger-side attributes equal the feed side's
    (NULL messenger attributes, i.e. receive-only users, take the feed's)."""
    f, m = feed_x.alias("f"), msg_x.alias("m")
    cond = (F.col("f.user") == F.col("m.user")) & (F.col("f.event_date") == F.col("m.event_date"))
    for c in DIMS:
        cond = cond & (F.col(f"m.{c}").isNull() | (F.col(f"m.{c}") == F.col(f"f.{c}")))
    j = f.join(m, cond, "inner")
    return j.select(*[F.col(f"f.{c}").alias(c) for c in ("event_date", "user", *DIMS)],
                    F.col("f.views"), F.col("f.likes"),
                    *[F.col(f"m.{c}") for c in METRICS if c not in ("views", "likes")])


def etl_slices(merged: DataFrame) -> DataFrame:
    """C34 slices: the six sums by (event_date, gender), (event_date, age) and
    (event_date, os) in one aggregation → (event_date, dimension, dimension_value, …)."""
    melted = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value"))
        for d in DIMS]))
    x = merged.select("event_date", melted.alias("dv"), *METRICS) \
        .select("event_date", "dv.dimension", "dv.dimension_value", *METRICS)
    return x.groupBy("event_date", "dimension", "dimension_value").agg(
        *[F.sum(c).cast("long").alias(c) for c in METRICS])


def etl_fact(merged: DataFrame) -> DataFrame:
    """C34 fact: the six sums by (event_date, gender, age, os)."""
    return merged.groupBy("event_date", *DIMS).agg(*[F.sum(c).cast("long").alias(c) for c in METRICS]) \
        .select("event_date", *DIMS, *METRICS)


def daily_fact(feed: DataFrame, messages: DataFrame, on_day, attribution: str = "receiver",
               view_action: str = "view") -> DataFrame:
    """The whole chain for one day: extracts → merge → fact."""
    fx = etl_feed_extract(feed, on_day, view_action)
    mx = etl_messenger_extract(messages, on_day, attribution)
    return etl_fact(etl_merge(fx, mx))
