"""Plan-shape checks: what would hurt at scale must not appear in any registered plan."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from tests.conftest import SF_SMALL

PYTHON_OK = {"aa_summary", "experiment_report", "welch_ttest_pvalues"}   # p-value tails only


def _batch_names():
    from cohortia.plans.catalog import all_queries as queries
    return sorted(n for n in queries() if not n.startswith("stream_") and n != "etl_fact_table")


@pytest.mark.parametrize("name", _batch_names())
def test_no_pairwise_join_and_python_only_for_pvalues(spark, name):
    from cohortia.plans.catalog import all_queries as queries
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan                    # never a row-at-a-time UDF
    if name not in PYTHON_OK:
        assert "ArrowEvalPython" not in plan


def test_date_filter_and_columns_reach_the_scan(spark):
    from cohortia.plans.catalog import all_queries as queries
    df = queries()["feed_daily_report"](spark, SF_SMALL)
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [line for line in text.split("\n") if line.startswith("PushedFilters")][0]
    schema = [line for line in text.split("\n") if line.startswith("ReadSchema")][0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "In(event_type" in pushed
    assert "props" not in schema and "value" not in schema     # unused columns are pruned


def test_activity_is_one_shuffle(spark):
    from cohortia.plans.catalog import all_queries as queries
    plan = queries()["user_day_activity"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


@pytest.mark.parametrize("name,max_scans", [
    ("kendall_matrix", 1), ("mann_whitney_ctr", 1), ("describe_by_group", 1), ("qq_points", 1),
    ("etl_fact", 2), ("audience_distribution", 1), ("user_day_activity", 2), ("retention_by_distance", 1),
    ("kpi_card", 1), ("metric_drop_by_dimension", 1), ("first_cohort_retention", 1),
    ("campaign_cohort_compare", 2), ("linearized_likes", 1), ("wau_mau_stickiness", 1)])
def test_raw_events_are_read_once_per_event_table(spark, name, max_scans):
    """Reduced intermediates read by several branches are materialized, so the raw table
    is scanned at most once per event table (the adapter reads feed and messages from
    the same file, hence 2 for two-table queries)."""
    from cohortia.plans.catalog import all_queries as queries
    df = queries()[name](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") <= max_scans


def test_no_registered_query_rescans_raw_tables(spark):
    """Audit of every batch query: the final AQE plan scans the raw table at most once per
    event table, told by the event types a scan filters (reduced intermediates are
    materialized instead); any other raw table is scanned once."""
    from cohortia.plans.catalog import all_queries as queries
    extra = {}
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        for name, q in queries().items():
            if name.startswith("stream_") or name in ("etl_fact_table", "etl_fact_tsv"):
                continue
            df = q(spark, SF_SMALL)
            df.collect()
            final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            scans = [re.search(r"DataFilters: \[(.*?)\], Format", s) for s in re.findall(r"FileScan parquet.*", final)]
            tables = Counter("feed" if s and re.search(r"\b(view|click)\b", s[1]) else
                             "messages" if s and re.search(r"\b(purchase|signup)\b", s[1]) else "other" for s in scans)
            if tables and max(tables.values()) > 1:
                extra[name] = dict(tables)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert not extra, extra
