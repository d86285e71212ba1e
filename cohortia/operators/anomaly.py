"""15-minute metric series and anomaly alerts.

The series is one aggregation over the union of both event tables (slots seen
in one service only get 0 for the other service's counters).  Detection runs
window functions partitioned by metric (and any extra key such as a
dimension), ordered by slot: every partition is one metric's series — at most
96 slots a day — so the work spreads over metrics × dimension values and no
window is unpartitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.functions.metrics import ratio
from cohortia.functions.timefn import as_timestamp, day, hm, slot15

SERIES_METRICS = ("users_feed", "views", "likes", "CTR", "users_messenger", "messages")


def metric_series_15min(feed: DataFrame, messages: DataFrame, as_of_ts,
                        horizon_days: int = 1) -> DataFrame:
    """C20: (ts, day, hm, users_feed, views, likes, CTR, users_messenger, messages).

    Slots from midnight ``horizon_days`` before ``as_of_ts`` up to, excluding,
    the slot containing ``as_of_ts`` (the incomplete slot is dropped, P6).
    CTR = 100·likes/views: 0 in a slot without feed actions (as every feed counter), NULL
    in a slot with feed actions but no views.
    """
    t = as_timestamp(as_of_ts)
    lo = F.date_sub(F.lit(t.date()), horizon_days).cast("timestamp")
    hi = slot15(F.lit(t).cast("timestamp"))
    cond = (F.col("time") >= lo) & (F.col("time") < hi)
    f = feed.where(cond).select(
        slot15().alias("ts"), "user_id", F.lit(True).alias("is_feed"),
        (F.col("action") == "view").cast("int").alias("v"),
        (F.col("action") == "like").cast("int").alias("l"), F.lit(0).alias("m"))
    m = messages.where(cond).select(
        slot15().alias("ts"), "user_id", F.lit(False).alias("is_feed"),
        F.lit(0).alias("v"), F.lit(0).alias("l"),
        F.col("reciever_id").isNotNull().cast("int").alias("m"))
    agg = (f.unionByName(m).groupBy("ts")
           .agg(F.countDistinct(F.when(F.col("is_feed"), F.col("user_id"))).alias("users_feed"),
                F.sum("v").cast("long").alias("views"),
                F.sum("l").cast("long").alias("likes"),
                F.countDistinct(F.when(~F.col("is_feed"), F.col("user_id"))).alias("users_messenger"),
                F.sum("m").cast("long").alias("messages"),
                F.count_if("is_feed").alias("_feed")))
    ctr = F.when(F.col("_feed") == 0, F.lit(0.0)).otherwise(ratio("likes", "views") * 100)
    return agg.select("ts", day("ts").alias("day"), hm("ts").alias("hm"), "users_feed", "views",
                      "likes", ctr.alias("CTR"), "users_messenger",
                      "messages")


def melt_series(series: DataFrame, metrics=SERIES_METRICS, ids=("ts", "day", "hm")) -> DataFrame:
    """Wide series → (ids…, metric, value double)."""
    wide = series.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def anomaly_bounds(long: DataFrame, n: int = 6, a: float = 4.0,
                   keys: tuple[str, ...] = ("metric",), order: str = "ts",
                   as_of_slot: bool = False) -> DataFrame:
    """IQR and sigma fences for every slot of every series.

    Row i uses the n previous rows (NULL unless all n are non-null), then each
    fence is smoothed by a centred mean over rows i−⌊n/2⌋ … i+⌊(n−1)/2⌋ that
    ignores NULLs (pandas ``rolling(n, center=True, min_periods=1)``).  ``as_of_slot``
    leaves out the rows after i, as if every slot were judged when it was the last one.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    prev = w.rowsBetween(-n, -1)
    full = F.count("value").over(prev) == n
    q25 = F.when(full, F.percentile("value", 0.25).over(prev))
    q75 = F.when(full, F.percentile("value", 0.75).over(prev))
    mean = F.when(full, F.avg("value").over(prev))
    std = F.when(full, F.stddev_samp("value").over(prev))
    raw = long.select("*", q25.alias("q25"), q75.alias("q75"), mean.alias("mean"), std.alias("std"))
    raw = raw.select("*", (F.col("q75") - F.col("q25")).alias("iqr"))
    raw = raw.select("*",
                     (F.col("q25") - a * F.col("iqr")).alias("low_q0"),
                     (F.col("q75") + a * F.col("iqr")).alias("up_q0"),
                     (F.col("mean") - a * F.col("std")).alias("low_s0"),
                     (F.col("mean") + a * F.col("std")).alias("up_s0"))
    centred = w.rowsBetween(-(n // 2), 0 if as_of_slot else (n - 1) // 2)
    out = raw.select(*[c for c in long.columns], "q25", "q75", "iqr", "mean", "std",
                     *[F.avg(c + "0").over(centred).alias(c)
                       for c in ("low_q", "up_q", "low_s", "up_s")])
    return out


def _fences(combine: str):
    lq, uq, ls, us = (F.col(c) for c in ("low_q", "up_q", "low_s", "up_s"))
    v = F.col("value")
    if combine == "iqr_else_sigma":
        # Python ``low_q or low_s``: the sigma fence only replaces an IQR fence that is exactly 0
        lower = F.when(lq == 0, ls).otherwise(lq)
        upper = F.when(uq == 0, us).otherwise(uq)
        return lower, upper, (v < lower) | (v > upper)
    if combine == "iqr":
        return lq, uq, (v < lq) | (v > uq)
    if combine == "sigma":
        return ls, us, (v < ls) | (v > us)
    out_q, out_s = (v < lq) | (v > uq), (v < ls) | (v > us)
    if combine == "any":
        return F.least(lq, ls), F.greatest(uq, us), out_q | out_s
    if combine == "all":
        return F.greatest(lq, ls), F.least(uq, us), out_q & out_s
    raise ValueError(f"unknown combine mode {combine!r}")


def anomaly_alerts(bounds: DataFrame, combine: str = "iqr_else_sigma",
                   keys: tuple[str, ...] = ("metric",), order: str = "ts",
                   only_alerts: bool = False) -> DataFrame:
    """The verdict for the last slot of each series.

    (keys…, ts, hm, value, prev_value, deviation = |1 − value/prev|, lower,
    upper, is_alert, equal_slots = sorted hm of all slots with the same value).
    NULL fences never alert.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    lower, upper, outside = _fences(combine)
    x = bounds.select(*keys, order, "hm", "value",
                      F.lag("value").over(w).alias("prev_value"),
                      lower.alias("lower"), upper.alias("upper"),
                      F.coalesce(outside, F.lit(False)).alias("is_alert"))
    # one row per series: its last slot, and its slots once
    x = x.groupBy(*keys).agg(
        F.max_by(F.struct(order, "hm", "value", "prev_value", "lower", "upper", "is_alert"), order).alias("r"),
        F.collect_list(F.struct("hm", "value")).alias("slots"))
    same = F.filter("slots", lambda slot: slot["value"] == F.col("r.value"))
    out = x.select(*keys, "r.*", F.array_sort(F.transform(same, lambda slot: slot["hm"])).alias("equal_slots"))
    out = out.select(*keys, order, "hm", "value", "prev_value",
                     F.abs(1 - F.try_divide(F.col("value"), F.col("prev_value"))).alias("deviation"),
                     "lower", "upper", "is_alert", "equal_slots")
    return out.where("is_alert") if only_alerts else out


def slot_verdicts(bounds: DataFrame, combine: str = "iqr_else_sigma", keys: tuple[str, ...] = ("metric",),
                  order: str = "ts") -> DataFrame:
    """The verdict for every slot: (keys…, ts, hm, value, prev_value, deviation, lower, upper, is_alert)."""
    w = Window.partitionBy(*keys).orderBy(order)
    lower, upper, outside = _fences(combine)
    x = bounds.select(*keys, order, "hm", "value", F.lag("value").over(w).alias("prev_value"),
                      lower.alias("lower"), upper.alias("upper"), F.coalesce(outside, F.lit(False)).alias("is_alert"))
    return x.select(*keys, order, "hm", "value", "prev_value",
                    F.abs(1 - F.try_divide(F.col("value"), F.col("prev_value"))).alias("deviation"),
                    "lower", "upper", "is_alert")


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alert rows rendered as text (metric, current value, deviation %, n/a after a 0)."""
    return alerts.where("is_alert").select(
        "metric", "ts",
        F.format_string("Metric %s:\ncurrent value: %.2f\ndeviation from previous: %s",
                        F.col("metric"), F.col("value"),
                        F.when(F.col("deviation").isNull(), "n/a")
                         .otherwise(F.format_string("%.2f%%", F.col("deviation") * 100))).alias("text"))
