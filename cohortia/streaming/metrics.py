"""Structured Streaming operators.

The reference polls the database every 15 minutes and only looks at complete
slots.  Here the two event streams are tagged, unioned and aggregated into
15-minute event-time windows behind a watermark; append mode emits a slot
exactly once, when the watermark has passed its end — the streaming form of
"drop the incomplete slot".  Exact distinct users per slot use chained
aggregation ((slot, user) first, then slot), because ``countDistinct`` is not
supported on streams.  State is bounded by the watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.sources.events import FEED_TYPES, MESSAGE_TYPES, feed_actions, message_actions


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of the raw ``events`` table at ``path``, one file or a folder of part files.

    ``max_files_per_trigger`` bounds a micro-batch; files must then arrive in event-time
    order, since rows behind the watermark of an earlier batch are dropped.
    """
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    return r.parquet(f"{folder}/{{{name}}}")       # as a pattern the path may be a file or a folder


def tagged_stream(events: DataFrame) -> DataFrame:
    """Both product streams as one: (time, user_id, is_feed, v, l, m, event_id)."""
    f = feed_actions(events.where(F.col("event_type").isin(*FEED_TYPES))).select(
        "time", "user_id", F.lit(True).alias("is_feed"),
        (F.col("action") == "view").cast("int").alias("v"),
        (F.col("action") == "like").cast("int").alias("l"), F.lit(0).alias("m"))
    m = message_actions(events.where(F.col("event_type").isin(*MESSAGE_TYPES))).select(
        "time", "user_id", F.lit(False).alias("is_feed"), F.lit(0).alias("v"), F.lit(0).alias("l"),
        F.col("reciever_id").isNotNull().cast("int").alias("m"))
    return f.unionByName(m)


def stream_metrics_15min(tagged: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """R1+R2: (ts, users_feed, views, likes, CTR, users_messenger, messages) per closed slot."""
    per_user = (tagged.withWatermark("time", delay)
                .groupBy(F.window("time", "15 minutes").alias("w"), "user_id", "is_feed")
                .agg(F.sum("v").alias("v"), F.sum("l").alias("l"), F.sum("m").alias("m")))
    slot = (per_user.groupBy("w")
            .agg(F.count_if(F.col("is_feed")).alias("users_feed"),
                 F.sum("v").cast("long").alias("views"), F.sum("l").cast("long").alias("likes"),
                 F.count_if(~F.col("is_feed")).alias("users_messenger"),
                 F.sum("m").cast("long").alias("messages")))
    return slot.select(F.col("w.start").alias("ts"), "users_feed", "views", "likes",
                       F.when(F.col("users_feed") == 0, F.lit(0.0)).otherwise(
                           F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")) * 100)
                       .alias("CTR"), "users_messenger", "messages")


def stream_sliding_activity(tagged: DataFrame, length: str = "1 hour", slide: str = "15 minutes",
                            delay: str = "30 minutes") -> DataFrame:
    """Sliding windows for live charts — events per window (views, likes, messages)."""
    return (tagged.withWatermark("time", delay)
            .groupBy(F.window("time", length, slide).alias("w"))
            .agg(F.sum("v").cast("long").alias("views"), F.sum("l").cast("long").alias("likes"),
                 F.sum("m").cast("long").alias("messages"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "views", "likes", "messages"))


def stream_sessions(tagged: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Per-user activity sessions (events closer than ``gap`` belong together)."""
    return (tagged.withWatermark("time", delay)
            .groupBy("user_id", F.session_window("time", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("events"), F.sum("v").cast("long").alias("views"),
                 F.sum("l").cast("long").alias("likes"), F.sum("m").cast("long").alias("messages"))
            .select("user_id", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "events", "views", "likes", "messages"))


def stream_dedup(events: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """Drop replayed events with the same key seen within the watermark delay."""
    return (events.withColumn("time", F.col("ts").cast("timestamp"))
            .withWatermark("time", delay).dropDuplicatesWithinWatermark([key]))


def run_to_table(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> None:
    """Drain a stream with ``availableNow`` into a parquet table (exactly-once file sink)."""
    q = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    q.awaitTermination()


def alert_batch_writer(series_path: str, alerts_path: str, n: int = 6, a: float = 4.0,
                       horizon_slots: int = 192):
    """``foreachBatch`` handler — a verdict for every slot that the batch closes, each
    judged as of that slot, with the series of earlier batches as its history.

    Slots close in time order, so earlier batches hold the earlier slots; ``horizon_slots``
    is how far back they are read (fences need n + ⌊n/2⌋ rows).  Every batch writes
    its own folder of both tables, so a batch that runs again replaces what it wrote.
    """
    from cohortia.operators.anomaly import anomaly_bounds, melt_series, slot_verdicts

    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{series_path}/epoch_id={epoch_id}"
        batch.write.mode("overwrite").parquet(own)
        closed = spark.read.schema(batch.schema).parquet(own)
        first = closed.agg(F.min("ts")).first()[0]
        if first is None:
            return
        series = spark.read.schema(f"{_ddl(batch)}, epoch_id bigint").parquet(series_path)
        before = series.where((F.col("epoch_id") < epoch_id) & (F.col("ts") < F.lit(first))
                              & (F.col("ts") >= F.lit(first - dt.timedelta(minutes=15 * horizon_slots))))
        recent = closed.unionByName(before.drop("epoch_id")).withColumn("day", F.to_date("ts")) \
            .withColumn("hm", F.date_format("ts", "HH:mm"))
        verdicts = slot_verdicts(anomaly_bounds(melt_series(recent), n, a, as_of_slot=True))
        verdicts.where(F.col("ts") >= F.lit(first)).write.mode("overwrite").parquet(
            f"{alerts_path}/epoch_id={epoch_id}")

    return handle


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
