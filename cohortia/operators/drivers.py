"""Root-cause slicing of a metric drop.

Which values of which dimension explain a DAU change between a day and its
base day (previous day or the same weekday a week earlier)?  All dimensions
are handled in one pass: every (user, day) is melted into one row per
(dimension, value) with ``explode`` over a fixed-size array, deduplicated with
partial aggregation, then counted per (dimension, value) for both days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.timefn import as_date, date_lit, day, on_days
from cohortia.session import materialize

DEFAULT_DIMS = ("country", "city", "os", "source", "hour")


def _dim_col(name: str):
    if name == "hour":
        return F.hour("time").cast("string")
    return F.col(name).cast("string")


def metric_drop_by_dimension(events: DataFrame, on_day, base: str = "day",
                             dims: tuple[str, ...] = DEFAULT_DIMS) -> DataFrame:
    """(dimension, value, users_day, users_base, delta, share_of_total_delta, vanished).

    ``base='day'`` compares with the previous day, ``'week'`` with 7 days
    earlier.  share_of_total_delta = delta / (DAU(day) − DAU(base));
    ``vanished`` marks values with users on the base day and none on the day
    (the published finding: whole cities absent).
    """
    d = as_date(on_day)
    b = d - _dt.timedelta(days=1 if base == "day" else 7)
    # half-open ranges on the raw timestamp reach the scan; the day() form does not
    ev = events.where(on_days("time", d, b))
    # a NULL pseudo-dimension carries the overall DAU through the same single pass
    melted = F.explode(F.array(*[
        F.struct(F.lit(n).alias("dimension"), _dim_col(n).alias("value")) for n in dims],
        F.struct(F.lit(None).cast("string").alias("dimension"), F.lit(None).cast("string").alias("value"))))
    pairs = (ev.select("user_id", day().alias("day"), melted.alias("dv"))
             .select("user_id", "day", "dv.dimension", "dv.value").distinct())
    # one row per dimension value, written once, as the values read the overall row
    agg = materialize(pairs.groupBy("dimension", "value")
                      .agg(F.count_if(F.col("day") == date_lit(d)).alias("users_day"),
                           F.count_if(F.col("day") == date_lit(b)).alias("users_base")))
    delta = F.col("users_day") - F.col("users_base")
    tot = agg.where(F.col("dimension").isNull()).select(delta.cast("double")).scalar()
    return (agg.where(F.col("dimension").isNotNull())
            .select("dimension", "value", "users_day", "users_base", delta.alias("delta"),
                    F.try_divide(delta.cast("double"), tot).alias("share_of_total_delta"),
                    ((F.col("users_day") == 0) & (F.col("users_base") > 0)).alias("vanished")))
