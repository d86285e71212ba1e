"""Calendar helpers as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT_SECONDS = 15 * 60


def as_date(d) -> _dt.date:
    """Accept ``date``, ``datetime`` or ISO string."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d)[:10])


def as_timestamp(t) -> _dt.datetime:
    if isinstance(t, _dt.datetime):
        return t
    if isinstance(t, _dt.date):
        return _dt.datetime(t.year, t.month, t.day)
    return _dt.datetime.fromisoformat(str(t))


def day(col: str | Column = "time") -> Column:
    """toDate(time)."""
    return F.to_date(col)


def slot15(col: str | Column = "time") -> Column:
    """toStartOfFifteenMinutes(time): the 15-minute slot start, same type as input."""
    return F.window(col, "15 minutes").start


def hour_start(col: str | Column = "time") -> Column:
    """toStartOfHour(time)."""
    return F.date_trunc("hour", col)


def monday(col: str | Column) -> Column:
    """toMonday(date): Monday of the ISO week (``trunc`` is Monday based)."""
    return F.trunc(F.to_date(col), "week")


def hm(col: str | Column) -> Column:
    """formatDateTime(ts, '%R') → 'HH:MM'."""
    return F.date_format(col, "HH:mm")


def date_lit(d) -> Column:
    return F.lit(as_date(d))


def on_days(col: str, *days) -> Column:
    """The timestamp ``col`` falls on one of ``days``, as OR-ed half-open ranges that push to the scan."""
    cond = F.lit(False)
    for d in map(as_date, days):
        cond = cond | ((F.col(col) >= F.lit(d)) & (F.col(col) < F.lit(d + _dt.timedelta(days=1))))
    return cond


def ts_lit(t) -> Column:
    return F.lit(as_timestamp(t)).cast("timestamp")


def seconds_between(a: str | Column, b: str | Column) -> Column:
    """b − a in whole seconds (DateTime subtraction)."""
    return F.unix_timestamp(b) - F.unix_timestamp(a)
