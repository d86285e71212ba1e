"""R6 with keyed state: the detector keeps each series' last slots itself.

``alert_batch_writer`` reads the stored series back for its history.  Here the
history is the state of a keyed operator: the last n + ⌊n/2⌋ values of a series
and the time of its last slot, whatever the stream's age, so a batch reads its
own slots only.  The series goes through a table in between, because Spark
takes no custom state behind an aggregation in one query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cohortia.operators.anomaly import SERIES_METRICS

STATE = "last_slot bigint, recent array<double>"


def _mean_of_known(x: np.ndarray) -> np.ndarray:
    known = ~np.isnan(x)
    count = known.sum(axis=1)
    return np.where(count > 0, np.where(known, x, 0.0).sum(axis=1) / np.maximum(count, 1), np.nan)


def fences(values: np.ndarray, n: int, a: float) -> dict[str, np.ndarray]:
    """Smoothed fences of ``values`` from position n + ⌊n/2⌋ on; NaN stands for no value."""
    before = np.lib.stride_tricks.sliding_window_view(values[:-1], n)       # row j: the n values before j + n
    known = ~np.isnan(before).any(axis=1)
    safe = np.where(known[:, None], before, 0.0)
    q25, q75 = np.quantile(safe, [0.25, 0.75], axis=1)
    mean = safe.mean(axis=1)
    std = safe.std(axis=1, ddof=1) if n > 1 else np.full(len(safe), np.nan)
    raw = {"low_q": q25 - a * (q75 - q25), "up_q": q75 + a * (q75 - q25), "low_s": mean - a * std, "up_s": mean + a * std}
    return {k: _mean_of_known(np.lib.stride_tricks.sliding_window_view(np.where(known, v, np.nan), n // 2 + 1))
            for k, v in raw.items()}


def detect_stream(long: DataFrame, n: int = 6, a: float = 4.0, keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """A verdict for every slot of a stream of (keys…, ts, value), judged as of that slot.

    (keys…, ts, hm, value, prev_value, deviation, lower, upper, is_alert), as
    ``slot_verdicts`` with ``combine="iqr_else_sigma"``.  A series' slots must come in time
    order from batch to batch; inside a batch any order will do.  A slot that isn't later
    than the last one judged is left out, so replayed slots aren't judged twice; of rows with
    equal slots in one batch the one with the smallest value is judged (no value comes last).
    State: one row a series, n + ⌊n/2⌋ values.
    """
    history = n + n // 2
    key_ddl = ", ".join(f"`{k}` {long.schema[k].dataType.simpleString()}" for k in keys)
    result = f"{key_ddl}, slot bigint, value double, prev_value double, lower double, upper double, is_alert boolean"

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, recent = state.get if state.exists else (None, [])
        rows = pd.concat([f[["slot", "value"]] for f in frames]).sort_values(["slot", "value"]).drop_duplicates("slot")
        if last is not None:
            rows = rows[rows["slot"] > last]
        if rows.empty:
            return
        new = rows["value"].to_numpy(dtype=float, na_value=np.nan)
        past = np.asarray([np.nan if v is None else v for v in recent], dtype=float)
        values = np.concatenate([np.full(history - len(past), np.nan), past, new])
        f = fences(values, n, a)
        lower = np.where(f["low_q"] == 0, f["low_s"], f["low_q"])
        upper = np.where(f["up_q"] == 0, f["up_s"], f["up_q"])
        state.update((int(rows["slot"].iloc[-1]), values[-history:].tolist()))
        yield pd.DataFrame({**dict(zip(keys, key, strict=True)), "slot": rows["slot"].to_numpy(), "value": new,
                            "prev_value": values[history - 1:-1], "lower": lower, "upper": upper,
                            "is_alert": (new < lower) | (new > upper)})

    slots = long.select(*keys, F.unix_micros("ts").alias("slot"), F.col("value").cast("double").alias("value"))
    judged = slots.groupBy(*keys).applyInPandasWithState(judge, result, STATE, "append", GroupStateTimeout.NoTimeout)
    known = {c: F.when(~F.isnan(c), F.col(c)) for c in ("value", "prev_value", "lower", "upper")}
    judged = judged.withColumns(known).withColumn("ts", F.timestamp_micros("slot"))
    return judged.select(*keys, "ts", F.date_format("ts", "HH:mm").alias("hm"), "value", "prev_value",
                         F.abs(1 - F.try_divide(F.col("value"), F.col("prev_value"))).alias("deviation"),
                         "lower", "upper", "is_alert")


def series_stream(spark, path: str, schema, metrics: tuple[str, ...] = SERIES_METRICS,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The stored series of closed slots at ``path`` as a stream of (metric, ts, value)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    wide = reader.parquet(path).select("ts", *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(["ts"], list(metrics), "metric", "value")
