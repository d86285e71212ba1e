"""Structured Streaming: late data behind the watermark does not change emitted slots."""

from __future__ import annotations

import os
import uuid

import pandas as pd

from cohortia.session import ensure_checkpoint_dir
from cohortia.streaming import metrics as sm


def _events(rows):
    return pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"])


def test_late_events_are_dropped_and_closed_slots_are_final(spark):
    base = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), f"stream_{uuid.uuid4().hex[:8]}")
    src, out, ckpt = base + "/src", base + "/out", base + "/ckpt"
    os.makedirs(src)
    t = pd.Timestamp("2024-01-10 10:00:00")
    first = _events([(i, t + pd.Timedelta(minutes=5 * i), i % 3, "view", 1.0, '{"k": 1}') for i in range(30)])
    spark.createDataFrame(first).write.mode("append").parquet(src + "/events_1.parquet")
    schema = spark.read.parquet(src + "/events_1.parquet").schema

    def run():
        ev = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(src + "/events_*")
        sm.run_to_table(sm.stream_metrics_15min(sm.tagged_stream(ev), "30 minutes"), out, ckpt)
        return spark.read.parquet(out).toPandas().set_index("ts").sort_index()

    r1 = run()
    # events end at 12:25 → watermark 11:55 → slots ending by 11:55 are closed and emitted
    assert r1.index.max() == pd.Timestamp("2024-01-10 11:30:00")
    assert r1.loc[pd.Timestamp("2024-01-10 10:00:00"), "views"] == 3
    late = _events([(1000, t + pd.Timedelta(minutes=1), 7, "view", 1.0, '{"k": 2}'),      # behind watermark
                    (1001, t + pd.Timedelta(hours=4), 8, "view", 1.0, '{"k": 2}')])       # moves watermark
    spark.createDataFrame(late).write.mode("append").parquet(src + "/events_2.parquet")
    r2 = run()
    assert r2.loc[pd.Timestamp("2024-01-10 10:00:00"), "views"] == 3                        # late row dropped
    assert r2.loc[pd.Timestamp("2024-01-10 10:00:00"), "users_feed"] == 3
    assert len(r2) > len(r1)                                                                 # more slots closed


def test_slot_of_one_service_has_ctr_zero_and_alerts_cover_every_closed_slot(spark, tmp_path):
    from pyspark.sql import functions as F

    from cohortia.operators.anomaly import metric_series_15min
    from cohortia.streaming.metrics import alert_batch_writer
    feed = spark.createDataFrame([(1, "view", "2024-01-01 10:01:00"), (2, "like", "2024-01-01 10:31:00")],
                                 "user_id long, action string, t string").withColumn("time", F.col("t").cast("timestamp"))
    messages = spark.createDataFrame([(1, 2, "2024-01-01 10:16:00")], "user_id long, reciever_id long, t string") \
        .withColumn("time", F.col("t").cast("timestamp"))
    series = metric_series_15min(feed, messages, "2024-01-01 12:00:00")
    got = {r.hm: r.CTR for r in series.collect()}
    assert got == {"10:00": 0.0, "10:15": 0.0, "10:30": None}       # messages only: 0, likes only: NULL

    slots = (spark.range(40).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=(F.col("id") * 15).cast("int")))
                                    .alias("ts"), "id")
             .select("ts", *[(F.col("id") % 7 + F.when(F.col("id") == 30, 500).otherwise(0)).cast("double").alias(c)
                             for c in ("users_feed", "views", "likes", "CTR", "users_messenger", "messages")]))
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    alert_batch_writer(str(whole / "series"), str(whole / "alerts"))(slots, 0)
    handle = alert_batch_writer(str(parts / "series"), str(parts / "alerts"))
    cut = F.lit("2024-01-01 06:00:00").cast("timestamp")
    for epoch, batch in ((0, slots.where(F.col("ts") < cut)), (1, slots.where(F.col("ts") >= cut)),
                         (1, slots.where(F.col("ts") >= cut)), (2, slots.where("false"))):
        handle(batch, epoch)
    read = lambda d: sorted(map(str, spark.read.parquet(str(d / "alerts")).drop("epoch_id").collect()))
    assert len(read(whole)) == 240 and read(whole) == read(parts)
    assert spark.read.parquet(str(whole / "alerts")).where("is_alert").select("hm").distinct().count() >= 1


def _slots(spark, n, first=0, odd=None):
    from pyspark.sql import functions as F
    bump = F.when(F.col("id") == odd, 500.0).otherwise(0.0) if odd is not None else F.lit(0.0)
    value = (F.col("id") * 7 % 5).cast("double") + bump
    at = F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=(F.col("id") * 15).cast("int"))
    return spark.range(first, n).coalesce(1).select(
        at.alias("ts"), value.alias("up"), F.when(F.col("id") % 11 != 3, value).alias("gaps"),
        F.lit(4.0).alias("flat"))


def test_stateful_detector_equals_the_batch_detector_over_restarts_and_replays(spark, tmp_path):
    from pyspark.sql import functions as F

    from cohortia.operators.anomaly import anomaly_bounds, melt_series, slot_verdicts
    from cohortia.streaming.detector import detect_stream, series_stream
    metrics = ("up", "gaps", "flat")
    whole = _slots(spark, 60, odd=41)
    batch = whole.withColumn("day", F.to_date("ts")).withColumn("hm", F.date_format("ts", "HH:mm"))
    want = slot_verdicts(anomaly_bounds(melt_series(batch, metrics), as_of_slot=True))

    def run():      # a new query each time: state comes back from the checkpoint
        out = detect_stream(series_stream(spark, str(tmp_path / "series"), whole.schema, metrics))
        q = (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
             .trigger(availableNow=True).start(str(tmp_path / "verdicts")))
        q.awaitTermination()
        return [p for p in q.recentProgress if p["stateOperators"]]

    cuts = [0, 1, 4, 20, 42, 43, 60]
    for a, b in zip(cuts, cuts[1:], strict=False):
        # every file after the first holds the two slots before it again
        _slots(spark, b, max(0, a - 2), odd=41).write.mode("append").parquet(str(tmp_path / "series"))
        assert run()[-1]["stateOperators"][0]["numRowsTotal"] == len(metrics)
    key = ["metric", "ts"]
    got = spark.read.parquet(str(tmp_path / "verdicts")).toPandas().sort_values(key).reset_index(drop=True)
    want = want.toPandas().sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_exact=False, rtol=1e-12, atol=1e-12)
    assert got[got.is_alert & (got.metric == "up")].hm.tolist() == ["10:15"] and not got[got.metric == "flat"].is_alert.any()
    assert not run() and spark.read.parquet(str(tmp_path / "verdicts")).count() == 180
