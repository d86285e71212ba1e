"""The audience overview on hand-made rows, and against the single operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cohortia.operators import audience as aud
from cohortia.operators.overview import audience_overview, interaction_by_dimensions


def _feed(spark, rows):
    return spark.createDataFrame([(u, t and dt.datetime(2024, *t, 12), s) for u, t, s in rows], "user_id long, time timestamp, source string")


def test_counts_by_hand(spark):
    f = _feed(spark, [(1, (1, 1), "ads"), (1, (1, 3), "ads"), (1, (1, 3), "organic"), (2, (1, 3), None), (None, (1, 3), "ads"),
                      (3, None, "ads"), (4, (2, 20), "ads")])
    got = {(r.section, r.key, r.part): r.users for r in audience_overview(f, "2024-01-02", "2024-01-04", ("source",)).collect()}
    day = lambda d: f"2024-01-0{d}"
    assert got == {("mau", day(2), None): 1, ("wau", day(2), None): 1, ("dau", day(3), None): 2, ("wau", day(3), None): 2, ("mau", day(3), None): 2,
                   ("wau", day(4), None): 2, ("mau", day(4), None): 2, ("retention", day(1), "0"): 1, ("retention", day(1), "2"): 1,
                   ("retention", day(3), "0"): 1, ("distribution", "source", "ads"): 1, ("distribution", "source", "organic"): 1,
                   ("distribution", "source", None): 1}
    assert audience_overview(f.limit(0), "2024-01-02", "2024-01-04", ("source",)).count() == 0


def test_a_user_leaves_after_thirty_days(spark):
    f = _feed(spark, [(1, (1, 1), "ads"), (1, (3, 5), "ads")])
    days = {(r.section, r.key) for r in audience_overview(f, "2024-01-01", "2024-03-06", ()).where("section <> 'retention'").collect()}
    assert ("mau", "2024-01-30") in days and ("mau", "2024-01-31") not in days and ("mau", "2024-03-05") in days
    assert ("wau", "2024-01-07") in days and ("wau", "2024-01-08") not in days


def test_interactions_equal_the_single_dimension(spark, events_small):
    f, m = events_small
    period = ("2024-01-10", "2024-01-12")
    both = interaction_by_dimensions(f, m, *period, dims=("os", "age"))
    for dim in ("os", "age"):
        one = aud.interaction_audience(f, m, dim, *period)
        assert both.where(F.col("dimension") == dim).select(*one.columns).exceptAll(one).count() == 0
        assert one.exceptAll(both.select(*one.columns)).count() == 0


def test_overview_reads_the_events_once(spark, events_small):
    df = audience_overview(events_small[0], "2024-01-01", "2024-01-30")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1
