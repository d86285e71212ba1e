
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortia.operators import activity as act
from cohortia.operators import audience as aud
from cohortia.operators import lifecycle, retention
from cohortia.functions.timefn import monday


def test_status_counts_add_up(events_small):
    feed, msgs = events_small
    s = act.dau_by_status(act.user_day_activity(feed, msgs))
    bad = s.where(F.col("dau") != F.col("dau_feed_only") + F.col("dau_messenger_only")
                  + F.col("dau_feed_messenger")).count()
    assert bad == 0


def test_new_plus_retained_is_weekly_active(events_small):
    feed, _ = events_small
    lc = lifecycle.user_lifecycle_weekly(feed, "2024-01-31").where(F.col("status") != "gone")
    per_week = lc.groupBy("this_week").agg(F.sum("num_users").alias("n"))
    wau = feed.groupBy(monday("time").alias("this_week")).agg(F.countDistinct("user_id").alias("w"))
    assert per_week.join(wau, "this_week").where(F.col("n") != F.col("w")).count() == 0
    assert per_week.count() == wau.count()


def test_retention_distance_zero_is_cohort_size(events_small):
    feed, _ = events_small
    r = retention.retention_by_distance(feed)
    first = feed.groupBy("user_id").agg(F.min(F.to_date("time")).alias("cohort")) \
        .groupBy("cohort").agg(F.count(F.lit(1)).alias("size"))
    zero = r.where("days_distance = 0").join(first, "cohort")
    assert zero.where(F.col("num_of_users") != F.col("size")).count() == 0
    assert r.where("retention_rate > 1.0").count() == 0


def test_wau_mau_bounds(events_small):
    feed, _ = events_small
    w = aud.wau_mau_stickiness(feed, "2024-01-01", "2024-01-30")
    assert w.where("dau > wau OR wau > mau OR stickiness > 1").count() == 0
    last = w.where(F.col("day") == dt.date(2024, 1, 30)).first()
    exact = feed.where(F.to_date("time").between("2024-01-01", "2024-01-30")).select("user_id").distinct().count()
    assert last.mau == exact


def test_lifecycle_approx_counts_close_to_exact(spark):
    from cohortia.sources.events import orders_activity
    from tests.conftest import SF_SMALL
    act_ = orders_activity(spark, SF_SMALL)
    exact = lifecycle.user_lifecycle_weekly(act_, "2001-08-02").toPandas()
    approx = lifecycle.user_lifecycle_weekly(act_, "2001-08-02", approx_rsd=0.02).toPandas()
    m = exact.merge(approx, on=["this_week", "previous_week", "status"], suffixes=("_e", "_a"))
    assert len(m) == len(exact)
    rel = ((m.num_users_a - m.num_users_e).abs() / m.num_users_e.abs()).max()
    assert rel <= 0.1
