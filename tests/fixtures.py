"""Hand-made edge fixtures (FIXTURES.md §4) as DataFrames with the event-table schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("post_id", T.LongType()),
    T.StructField("action", T.StringType()), T.StructField("time", T.TimestampType()),
    T.StructField("gender", T.IntegerType()), T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("exp_group", T.IntegerType())])
MSG_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("gender", T.IntegerType()), T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("exp_group", T.IntegerType())])


def ts(day: int, h: int = 12, m: int = 0, month: int = 1) -> dt.datetime:
    return dt.datetime(2024, month, day, h, m)


def feed_row(user, post, action, when, gender=0, age=20, os="iOS", source="ads", country="X",
             city="Y", exp_group=1):
    return (user, post, action, when, gender, age, os, source, country, city, exp_group)


def msg_row(user, to, when, gender=0, age=20, os="iOS", source="ads", country="X", city="Y",
            exp_group=1):
    return (user, to, when, gender, age, os, source, country, city, exp_group)


def frames(spark, feed_rows, msg_rows):
    return (spark.createDataFrame(feed_rows, FEED_SCHEMA),
            spark.createDataFrame(msg_rows, MSG_SCHEMA))
