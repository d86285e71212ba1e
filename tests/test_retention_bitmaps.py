"""Retention from stored bitmaps against the query over all events."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortia.operators.retention import retention_by_distance
from cohortia.operators.retention_bitmaps import add_day, build_retention, daily_user_bitmaps, stored_retention

DAY = dt.date(2024, 1, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.select("cohort", "days_distance", "num_of_users", "retention_rate").collect())


@pytest.fixture(scope="module")
def events(spark):
    """Ids over several buckets and below zero, days without any event, rows without a user or a time."""
    days = {0: [0, 1, 32768, 32769, -5], 1: [1, 70000, -32768], 3: [0, 70000, 32769, 2], 4: [2, 2, 2, 900000]}
    rows = [(u, dt.datetime(2024, 1, 1 + d, 9 + i % 9)) for d, us in days.items() for i, u in enumerate(us)]
    rows += [(None, dt.datetime(2024, 1, 2)), (77, None)]
    return spark.createDataFrame(rows, "user_id long, time timestamp")


def test_day_by_day_equals_all_at_once(spark, events, tmp_path):
    path = str(tmp_path / "r")
    expected = _rows(retention_by_distance(events.where("user_id is not null and time is not null")))
    build_retention(events, path, DAY)
    for i in (1, 2, 3, 4, 4):                           # the third day has no event; the last runs twice
        add_day(events, path, DAY + dt.timedelta(days=i))
    assert _rows(stored_retention(spark, path)) == expected
    bulk = str(tmp_path / "bulk")
    build_retention(events, bulk, DAY + dt.timedelta(days=4))
    assert _rows(stored_retention(spark, bulk)) == expected


def test_days_out_of_order_are_refused(events, tmp_path):
    path = str(tmp_path / "r")
    build_retention(events, path, DAY + dt.timedelta(days=1))
    for i in (0, 3):
        with pytest.raises(ValueError):
            add_day(events, path, DAY + dt.timedelta(days=i))


def test_bitmaps_follow_users_not_events(events):
    many = events.unionByName(events).unionByName(events)
    users = lambda df: {(r.day, r.bucket): r.n for r in df.select("day", "bucket", F.bitmap_count("users").alias("n")).collect()}
    assert users(daily_user_bitmaps(many)) == users(daily_user_bitmaps(events))
