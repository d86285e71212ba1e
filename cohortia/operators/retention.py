"""Retention cohorts.

Plan shape for every variant: one aggregation keyed by ``user_id`` that keeps
the user's *set of active days* (``collect_set`` — partial aggregation on the
map side, so a hot user ships one small set per map task) and any per-user
attribute (``max(source)``).  The set is bounded by the number of calendar days
in the data, not by the number of events.  The birthday is ``array_min`` of the
set, so the reference's self-join to ``MIN(day)`` disappears; exploding the set
gives one row per (user, day) and a final partial aggregation counts users per
(cohort, day).  Counting rows equals COUNT(DISTINCT user_id) because each
(user, day) occurs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.functions.timefn import as_date, date_lit, day
from cohortia.session import materialize


def user_day_sets(events: DataFrame, attrs: dict[str, str] | None = None,
                  until=None) -> DataFrame:
    """(user_id, days array<date>, birthday, *attrs) — one row per user.

    ``attrs`` maps output name → column aggregated with ``max`` (A9).
    """
    ev = events
    if until is not None:
        ev = ev.where(day() <= date_lit(until))
    aggs = [F.collect_set(day()).alias("days")]
    for out, col in (attrs or {}).items():
        aggs.append(F.max(col).alias(out))
    return (ev.groupBy("user_id").agg(*aggs)
            .withColumn("birthday", F.array_min("days")))


def _explode_days(sets: DataFrame, *keep: str) -> DataFrame:
    return sets.select("user_id", "birthday", *keep, F.explode("days").alias("day"))


def retention_by_distance(feed: DataFrame) -> DataFrame:
    """(cohort, days_distance, num_of_users, retention_rate).

    retention_rate = users at distance d / users at distance 0 of the cohort
    (the window runs over the aggregated cohort table, at most days² rows).
    """
    cnt = (_explode_days(user_day_sets(feed))
           .groupBy(F.col("birthday").alias("cohort"),
                    F.datediff("day", "birthday").alias("days_distance"))
           .agg(F.count(F.lit(1)).alias("num_of_users")))
    w = Window.partitionBy("cohort")
    base = F.max(F.when(F.col("days_distance") == 0, F.col("num_of_users"))).over(w)
    return cnt.withColumn("retention_rate", F.try_divide(F.col("num_of_users").cast("double"), base))


def first_cohort_retention(feed: DataFrame) -> DataFrame:
    """C11: active users per day among users whose first day is the first day of the data.

    The first day is an uncorrelated scalar subquery (J9), evaluated once.
    """
    sets = materialize(user_day_sets(feed))       # one row per user, read twice below
    first_day = sets.select(F.min("birthday")).scalar()
    sets = sets.where(F.col("birthday") == first_day)
    return (_explode_days(sets).groupBy("day")
            .agg(F.count(F.lit(1)).alias("num_users")))


def _cohort_counts(events: DataFrame, lo, hi, bound_days: bool, as_strings: bool) -> DataFrame:
    sets = (user_day_sets(events, {"source": "source"})
            .where(F.col("birthday").between(date_lit(lo), date_lit(hi))))
    x = _explode_days(sets, "source")
    if bound_days:
        x = x.where(F.col("day").between(date_lit(lo), date_lit(hi)))
    out = x.groupBy("birthday", "day", "source").agg(F.count(F.lit(1)).alias("num_of_users"))
    if as_strings:
        out = out.select(F.col("birthday").cast("string").alias("birthday"),
                         F.col("day").cast("string").alias("day"), "source", "num_of_users")
    return out


def retention_by_source(feed: DataFrame, as_of, window_days: int = 20) -> DataFrame:
    """(birthday, day, source, num_of_users) for cohorts born in
    [as_of − window_days, as_of]; source is the user's MAX(source) (quirk D9);
    dates rendered as strings like ``toString``."""
    d = as_date(as_of)
    import datetime as _dt
    return _cohort_counts(feed, d - _dt.timedelta(days=window_days), d, False, True)


def app_retention(feed: DataFrame, messages: DataFrame, as_of, window_days: int = 30,
                  bound_days: bool = False, as_strings: bool = True) -> DataFrame:
    """Feed retention + messenger retention, summed per (birthday, day, source).

    As in the reference, each service has its own birthday and a user active in
    both services is counted twice (quirk D12; see ``app_retention_distinct``).
    ``bound_days`` also bounds ``day`` to the window (the date-typed variant, D14).
    """
    import datetime as _dt
    d = as_date(as_of)
    lo, hi = d - _dt.timedelta(days=window_days), d - _dt.timedelta(days=1)
    both = (_cohort_counts(feed, lo, hi, bound_days, as_strings)
            .unionByName(_cohort_counts(messages, lo, hi, bound_days, as_strings)))
    return (both.groupBy("birthday", "day", "source")
            .agg(F.sum("num_of_users").cast("long").alias("num_of_users")))


def app_retention_distinct(feed: DataFrame, messages: DataFrame, as_of,
                           window_days: int = 30) -> DataFrame:
    """C13 (distinct): one app-wide birthday per user over both services, each
    user counted once per day; source = MAX over both services."""
    import datetime as _dt
    d = as_date(as_of)
    lo, hi = d - _dt.timedelta(days=window_days), d - _dt.timedelta(days=1)
    ev = feed.select("user_id", "time", "source").unionByName(
        messages.select("user_id", "time", "source"))
    sets = (user_day_sets(ev, {"source": "source"})
            .where(F.col("birthday").between(date_lit(lo), date_lit(hi))))
    x = _explode_days(sets, "source").where(F.col("day").between(date_lit(lo), date_lit(hi)))
    return x.groupBy("birthday", "day", "source").agg(F.count(F.lit(1)).alias("num_of_users"))


def campaign_cohort_compare(feed: DataFrame, messages: DataFrame, as_of,
                            window_days: int = 30) -> DataFrame:
    """How a cohort compares with the others.

    Per (birthday, days_distance): num_of_users, cohort_size (distance 0),
    size_ratio = cohort_size / median cohort size, and activity_ratio =
    num_of_users / median num_of_users of all cohorts at the same distance.
    Input is the distinct app-wide retention; the medians run over the
    aggregated cohort table (≤ window_days² rows).
    """
    r = materialize(app_retention_distinct(feed, messages, as_of, window_days)
                    .groupBy("birthday", "day").agg(F.sum("num_of_users").cast("long").alias("num_of_users"))
                    .withColumn("days_distance", F.datediff("day", "birthday")))   # cohort table
    wc = Window.partitionBy("birthday")
    r = r.withColumn("cohort_size",
                     F.max(F.when(F.col("days_distance") == 0, F.col("num_of_users"))).over(wc))
    sizes = r.where(F.col("days_distance") == 0).select(
        F.percentile(F.col("num_of_users").cast("double"), 0.5)).scalar()
    wd = Window.partitionBy("days_distance")
    med_d = F.percentile(F.col("num_of_users").cast("double"), 0.5).over(wd)
    return r.select("birthday", "days_distance", "num_of_users", "cohort_size",
                    F.try_divide(F.col("cohort_size").cast("double"), sizes).alias("size_ratio"),
                    F.try_divide(F.col("num_of_users").cast("double"), med_d).alias("activity_ratio"))
