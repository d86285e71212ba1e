"""Users from merged daily sketches against exact counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortia.operators.sketches import active_users_from_sketches, daily_user_sketches, weekly_change_from_sketches


def test_large_days_stay_within_the_error(spark):
    # 60,000 users a day, moving on by 20,000 a day
    days = spark.range(10).select(F.col("id").alias("d"))
    events = days.select("d", F.explode(F.sequence(F.lit(0), F.lit(59_999))).alias("i")).select(
        (F.col("d") * 20_000 + F.col("i")).alias("user_id"),
        F.expr("timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, CAST(d AS INT))").alias("time"))
    s = daily_user_sketches(events.unionByName(events.limit(1000)))
    got = {r.day.day: r for r in active_users_from_sketches(s, "2024-01-01", "2024-01-10").collect()}
    assert len(got) == 10
    for k, r in got.items():
        for value, exact in ((r.dau, 60_000), (r.wau, 60_000 + 20_000 * min(k - 1, 6)), (r.mau, 60_000 + 20_000 * (k - 1))):
            assert abs(value / exact - 1) < 4 * 0.0081
    weeks = {r.this_week.day: r for r in weekly_change_from_sketches(s).collect()}
    assert abs(weeks[8].retained - 40_000) < 4 * 0.0081 * 280_000 and weeks[1].retained == 0 and weeks[1].gone == 0


def test_empty_and_missing(spark):
    rows = spark.createDataFrame([(None, None), (1, None)], "user_id long, time timestamp")
    assert daily_user_sketches(rows).count() == 0
    assert active_users_from_sketches(daily_user_sketches(rows), "2024-01-01", "2024-01-02").count() == 0
    assert weekly_change_from_sketches(daily_user_sketches(rows)).count() == 0
