"""Retention kept up day by day with bitmaps.

A day's users are bits: one bitmap of 32,768 users (4 KB) per bucket of user ids.  Two tables
are stored, a folder a day: ``active`` (the users of the day) and ``seen`` (the users of all days
up to it).  Users seen by day c grow with c, so the users of day d that belong to cohort c are
|active(d) ∩ seen(c)| − |active(d) ∩ seen(c−1)|: a new day reads its own events and stored
bitmaps, never events of earlier days and no table of users.

The work of a day is buckets × cohorts bitmaps, whatever a user's number of events.  A day's
tables take 4 KB a bucket, so user ids should be dense integers (``functions.ranks.dense_index``
makes them so).  A bucket's rows at one task are bounded by the cohorts looked back on.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortia.functions.metrics import ratio
from cohortia.functions.timefn import as_date, date_lit, day


def daily_user_bitmaps(events: DataFrame) -> DataFrame:
    """(day, bucket, users): the day's users as bits.  Rows without a user or a time are left
    out; an empty table gives no rows."""
    return (events.where(F.col("user_id").isNotNull() & F.col("time").isNotNull())
            .groupBy(day().alias("day"), F.bitmap_bucket_number(F.col("user_id")).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("user_id"))).alias("users")))


def seen_bitmaps(active: DataFrame, last) -> DataFrame:
    """(day, bucket, users) of all users active up to each day, from the first active day to ``last``."""
    spread = active.select("bucket", "users", F.explode(F.sequence(F.col("day"), date_lit(last))).alias("day"))
    return spread.groupBy("day", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def cohort_counts(active: DataFrame, seen: DataFrame) -> DataFrame:
    """(cohort, day, num_of_users) for the days of ``active`` and every cohort up to them.

    ``seen`` holds every calendar day without gaps.  The join is by bucket and so is the grouping:
    one shuffle of the bitmaps serves both.
    """
    a = active.select("bucket", F.col("day"), F.col("users").alias("a"))
    s = seen.select("bucket", F.col("day").alias("cohort"), F.col("users").alias("s"))
    both = a.join(s, "bucket").where(F.col("cohort") <= F.col("day"))
    shared = (both.select("bucket", "cohort", "day", F.explode(F.array("a", "s")).alias("users"))
              .groupBy("bucket", "cohort", "day").agg(F.bitmap_count(F.bitmap_and_agg("users")).alias("n")))
    upto = shared.groupBy("cohort", "day").agg(F.sum("n").alias("n"))
    before = F.lag("n", 1, 0).over(Window.partitionBy("day").orderBy("cohort"))
    return (upto.select("cohort", "day", (F.col("n") - before).alias("num_of_users"))
            .where("num_of_users > 0"))


def _days(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema("bucket bigint, users binary, day date").parquet(f"{path}/{table}")


def build_retention(events: DataFrame, path: str, until) -> None:
    """Write active, seen and retention of all days up to ``until`` to a fresh folder ``path``."""
    spark, until = events.sparkSession, as_date(until)
    write = lambda df, name: df.repartition("day").write.partitionBy("day").parquet(f"{path}/{name}")
    write(daily_user_bitmaps(events.where(day() <= date_lit(until))), "active")
    write(seen_bitmaps(_days(spark, path, "active"), until), "seen")
    write(cohort_counts(_days(spark, path, "active"), _days(spark, path, "seen")), "retention")


def add_day(events: DataFrame, path: str, on_day) -> None:
    """Add one day: only its events are read.  The day after the last stored one, or the last stored
    one again (a retry replaces its folders, retention last); any other day is an error, as later
    days were built on it.
    """
    spark, d = events.sparkSession, as_date(on_day)
    last = _days(spark, path, "seen").agg(F.max("day")).first()[0]
    if last is not None and d not in (last, last + _dt.timedelta(days=1)):
        raise ValueError(f"{d} can't be added: the last stored day is {last}")
    write = lambda df, name: df.drop("day").write.mode("overwrite").parquet(f"{path}/{name}/day={d}")
    write(daily_user_bitmaps(events.where(day() == date_lit(d))), "active")
    active = spark.read.schema("bucket bigint, users binary").parquet(f"{path}/active/day={d}").withColumn("day", date_lit(d))
    before = _days(spark, path, "seen").where(F.col("day") == date_lit(d - _dt.timedelta(days=1)))
    write(before.select("bucket", "users").unionByName(active.select("bucket", "users"))
          .groupBy("bucket").agg(F.bitmap_or_agg("users").alias("users")), "seen")
    write(cohort_counts(active, _days(spark, path, "seen").where(F.col("day") <= date_lit(d))), "retention")


def stored_retention(spark: SparkSession, path: str) -> DataFrame:
    """(cohort, days_distance, num_of_users, retention_rate) as ``retention_by_distance`` gives it."""
    r = spark.read.schema("cohort date, num_of_users bigint, day date").parquet(f"{path}/retention")
    r = r.select("cohort", F.datediff("day", "cohort").alias("days_distance"), "num_of_users")
    size = F.max(F.when(F.col("days_distance") == 0, F.col("num_of_users"))).over(Window.partitionBy("cohort"))
    return r.withColumn("retention_rate", ratio(F.col("num_of_users"), size))
