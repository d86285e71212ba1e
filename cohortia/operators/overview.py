"""The audience overview in one scan, and services by every dimension in one pass.

Each user becomes one row: the sorted set of active days and the set of values of every
dimension, bounded by the calendar and by the few values of a user.  All sections of the dashboard are
exploded from that row and counted in one grouping, so the events are read and shuffled once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.functions.timefn import as_date, date_lit, day

DIMS = ("age", "gender", "os", "source", "country")


def _row(section: Column, key: Column, part: Column, age: Column) -> Column:
    return F.struct(section.alias("section"), key.cast("string").alias("key"), part.cast("string").alias("part"),
                    age.cast("int").alias("age"))


def _active_rows(start, end) -> Column:
    """A row for every day of [start, end] that the user counts for: an active day covers the 29
    days after it, up to the next active day, which takes over."""
    n = F.size("days")
    upto = lambda d, i: F.least(F.date_add(d, 29), date_lit(end), F.coalesce(
        F.when(i < n - 1, F.date_sub(F.get("days", i + 1), 1)), F.date_add(d, 29)))
    spans = F.transform("days", lambda d, i: F.struct(d.alias("day"), upto(d, i).alias("last")))
    spans = F.filter(spans, lambda s: s["last"] >= date_lit(start))
    return F.flatten(F.transform(spans, lambda s: F.transform(
        F.sequence(F.greatest(s["day"], date_lit(start)), s["last"]),
        lambda d: _row(F.lit("active"), d, F.lit(None), F.datediff(d, s["day"])))))


def _distribution_rows(dim: str, values: Column) -> Column:
    return F.transform(values, lambda s: _row(F.lit("distribution"), F.lit(dim), s["v"], F.lit(None)))


def audience_overview(feed: DataFrame, start, end, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """(section, key, part, users), one row for each count that isn't 0:

    * dau, wau, mau: ``key`` is a day of [start, end]; users active on it, in its 7 and in its 30 days;
    * retention: ``key`` is the first day of all days up to ``end``, ``part`` the days since;
    * distribution: ``key`` is a dimension, ``part`` its value (null too), users active in [start, end].

    Rows without a user or a time are left out; an empty table gives no rows.
    """
    start, end = as_date(start), as_date(end)
    f = feed.where(F.col("user_id").isNotNull() & (day() <= date_lit(end)))
    inside = day() >= date_lit(start)
    u = f.groupBy("user_id").agg(F.array_sort(F.collect_set(day())).alias("days"), *[
        F.collect_set(F.when(inside, F.struct(F.col(d).cast("string").alias("v")))).alias(f"_{i}") for i, d in enumerate(dims)])
    birthday = F.get("days", F.lit(0))
    sections = [_active_rows(start, end), F.transform("days", lambda d: _row(
        F.lit("retention"), birthday, F.datediff(d, birthday), F.lit(None)))]
    sections += [_distribution_rows(d, F.col(f"_{i}")) for i, d in enumerate(dims)]
    n = (u.select(F.explode(F.concat(*sections)).alias("r")).select("r.*").groupBy("section", "key", "part")
         .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("age") < 7).alias("week"), F.count_if(F.col("age") == 0).alias("day")))
    count = lambda section, c: F.struct(section.alias("section"), F.col(c).alias("users"))
    counts = F.when(F.col("section") == "active", F.array(
        count(F.lit("dau"), "day"), count(F.lit("wau"), "week"), count(F.lit("mau"), "n"))).otherwise(F.array(count(F.col("section"), "n")))
    return n.select("key", "part", F.explode(counts).alias("c")).select("c.section", "key", "part", "c.users").where("users > 0")


def interaction_by_dimensions(feed: DataFrame, messages: DataFrame, start, end, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """C19 for every dimension in one pass: (dimension, value, status, users) over [start, end], as
    ``interaction_audience`` counts one: a user's value is the largest of both services."""
    s, e = as_date(start), as_date(end)
    side = lambda df, name: df.where((F.col("time") >= F.lit(s)) & (F.col("time") < F.lit(e + _dt.timedelta(days=1)))).select(
        "user_id", *dims, F.lit(name).alias("service"))
    both = side(feed, "feed").unionByName(side(messages, "messenger"))
    u = both.groupBy("user_id").agg(*[F.max(d).alias(d) for d in dims], F.min("service").alias("first"), F.max("service").alias("last"))
    status = F.when(F.col("first") != F.col("last"), F.lit("feed+messenger")).otherwise(F.concat("first", F.lit("_only")))
    values = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])
    return (u.select(status.alias("status"), F.explode(values).alias("x")).groupBy("x.dimension", "x.value", "status")
            .agg(F.count(F.lit(1)).alias("users")))
