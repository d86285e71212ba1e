"""The composite jobs run end to end and their sinks are idempotent."""

from __future__ import annotations

import os
import uuid

from cohortia.plans import jobs
from cohortia.session import ensure_checkpoint_dir


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), f"{name}_{uuid.uuid4().hex[:8]}")


def test_daily_etl_rerun_replaces_the_day(spark, events_small):
    feed, msgs = events_small
    path = _scratch(spark, "fact")
    fact, _ = jobs.run_daily_etl(feed, msgs, "2024-01-30", path)
    n = fact.count()
    jobs.run_daily_etl(feed, msgs, "2024-01-30", path)          # retry: same partition replaced
    jobs.run_daily_etl(feed, msgs, "2024-01-29", path)          # another day added
    back = spark.read.parquet(path)
    assert back.where("event_date = '2024-01-30'").count() == n
    assert back.select("event_date").distinct().count() == 2


def test_alert_job_and_reports(spark, events_small):
    feed, msgs = events_small
    v = jobs.run_alerts(feed, msgs, "2024-01-30 12:07:30", _scratch(spark, "alerts"))
    assert v.count() == 6
    path = _scratch(spark, "alerts")
    for _ in range(2):                                          # a retry replaces its slot
        v = jobs.run_alerts(feed, msgs, "2024-01-30 12:07:30", path, n=2, a=0.01)
    back = spark.read.schema(v.schema).parquet(f"{path}/day=2024-01-30/slot=1145")
    assert back.count() == v.where("is_alert").count() > 0
    rep = jobs.run_feed_report(feed, "2024-01-31")
    assert rep["table"].count() == 7 and rep["latest"].count() == 1
    app = jobs.run_app_report(feed, msgs, "2024-01-31")
    assert app["dau_by_status"].count() == 30


def test_audience_dashboard(events_small):
    feed, msgs = events_small
    dash = jobs.run_audience_dashboard(feed, msgs, "2024-01-31")
    assert dash["wau_mau_stickiness"].count() == 30
    assert dash["kpi_card"].count() == 1
    assert dash["distribution_os"].count() == 2
