"""The reference's scheduled entry points as single Spark jobs.

* ``run_alerts``     — E1: 15-minute series → fences → verdicts, the slot's alerts replaced;
* ``run_daily_etl``  — E2: extracts → merge → slices + fact, each day's partition replaced;
* ``run_feed_report`` / ``run_app_report`` — the daily report rows and chart series;
* ``run_ab_report``  — E3: every experiment method in one table.

Each returns DataFrames (lazy) or writes with idempotent modes; nothing is
collected except the handful of alert rows a caller may want to print.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.functions.timefn import as_timestamp
from cohortia.operators import activity as act
from cohortia.operators import anomaly, etl
from cohortia.operators import experiment as ex
from cohortia.sources.sinks import report_rows, write_fact


def run_alerts(feed: DataFrame, messages: DataFrame, as_of_ts, alerts_path: str | None = None,
               n: int = 6, a: float = 4.0, combine: str = "iqr_else_sigma") -> DataFrame:
    """Verdicts for the last complete slot of each metric; rows with ``is_alert``
    replace the slot's own folder of ``alerts_path`` (parquet, by day and slot) when given, so
    that a job that runs again, or finds no alert any more, leaves no older rows behind."""
    series = anomaly.metric_series_15min(feed, messages, as_of_ts)
    verdicts = anomaly.anomaly_alerts(anomaly.anomaly_bounds(anomaly.melt_series(series), n, a), combine)
    if alerts_path:
        t = as_timestamp(as_of_ts)
        slot = t - dt.timedelta(minutes=t.minute % 15 + 15, seconds=t.second, microseconds=t.microsecond)
        verdicts.where("is_alert").write.mode("overwrite").parquet(f"{alerts_path}/day={slot:%Y-%m-%d}/slot={slot:%H%M}")
    return verdicts


def run_daily_etl(feed: DataFrame, messages: DataFrame, on_day, fact_path: str | None = None,
                  slices_path: str | None = None, attribution: str = "receiver",
                  view_action: str = "view") -> tuple[DataFrame, DataFrame]:
    """(fact, slices) for one day; written with dynamic partition overwrite, so a
    retried run replaces the day instead of appending duplicates."""
    merged = etl.etl_merge(etl.etl_feed_extract(feed, on_day, view_action),
                           etl.etl_messenger_extract(messages, on_day, attribution))
    fact, slices = etl.etl_fact(merged), etl.etl_slices(merged)
    if fact_path:
        write_fact(fact, fact_path)
    if slices_path:
        write_fact(slices, slices_path, sort_cols=("dimension", "dimension_value"))
    return fact, slices


def run_feed_report(feed: DataFrame, as_of, days: int = 7) -> dict[str, DataFrame]:
    """The feed report: the 7-day table, its text rows and the latest day."""
    table = act.feed_daily_report(feed, as_of, days)
    return {"table": table,
            "text": report_rows(table, ["dau", "views", "likes", "ctr"]),
            "latest": act.latest_rows(table, "day")}


def run_app_report(feed: DataFrame, messages: DataFrame, as_of) -> dict[str, DataFrame]:
    """The whole-app report: status DAU, totals and averages for yesterday and history,
    15-minute slot charts for yesterday, new users by first-day status."""
    import datetime as _dt
    from cohortia.functions.timefn import as_date
    y = as_date(as_of) - _dt.timedelta(days=1)
    days = act.user_day_activity(feed, messages, end=y)
    slots = act.user_slot_activity(feed, messages, y)
    return {
        "dau_by_status": act.dau_by_status(days, "day"),
        "dau_by_status_slot": act.dau_by_status(slots, "mins_15"),
        "event_totals_daily": act.event_totals(days, "day"),
        "event_totals_slot": act.event_totals(slots, "mins_15", label="hours_mins"),
        "avg_events_daily": act.avg_events_daily(days),
        "avg_events_yesterday": act.avg_events_per_user(feed, messages, y),
        "new_users_yesterday": act.new_users_on(feed, messages, y),
        "new_users_daily": act.new_users_daily(days),
    }


def run_ab_report(feed: DataFrame, start, end, control: int, test: int, **kw) -> DataFrame:
    """Every method of the A/B analysis as rows (metric, method, statistic, p-values)."""
    return ex.experiment_report(feed, start, end, control, test, **kw)


def run_audience_dashboard(feed: DataFrame, messages: DataFrame, as_of, period_days: int = 30,
                           dims: tuple[str, ...] = ("age", "gender", "os", "source", "country")
                           ) -> dict[str, DataFrame]:
    """The dashboard data — DAU/WAU/MAU/stickiness, retention, audience
    distributions, KPI card, live offsets, top posts/users and service interaction."""
    import datetime as _dt
    from cohortia.functions.timefn import as_date
    from cohortia.operators import audience as aud
    from cohortia.operators import retention
    y = as_date(as_of) - _dt.timedelta(days=1)
    start = y - _dt.timedelta(days=period_days - 1)
    out = {
        "wau_mau_stickiness": aud.wau_mau_stickiness(feed, start, y),
        "retention": retention.retention_by_distance(feed),
        "kpi_card": aud.kpi_card(feed, y),
        "live_offsets": aud.live_offsets(feed, y),
        "top_posts": aud.top_posts(feed, 10, "views", time_from=start),
        "top_users": aud.top_users(feed, 10, "views", time_from=start),
        "user_bubbles": aud.user_bubbles(feed, messages, start, y),
    }
    for d in dims:
        out[f"distribution_{d}"] = aud.audience_distribution(feed, d, start, y)
        out[f"interaction_{d}"] = aud.interaction_audience(feed, messages, d, start, y)
    return out
