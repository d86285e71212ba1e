"""Small helpers: cluster sizing and dashboard slicers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortia.operators.audience import filter_slice
from cohortia.session import scale_conf


@pytest.mark.parametrize("tb,executors,cores,mem", [(100, 1000, 8, 32), (1, 10, 4, 16), (0.01, 2, 4, 8)])
def test_scale_conf_bounds(tb, executors, cores, mem):
    c = scale_conf(int(tb * 1024 ** 4), executors, cores, mem)
    total = executors * cores
    n = int(c["spark.sql.shuffle.partitions"])
    assert 2 * total <= n <= 8 * total and n % total == 0
    assert int(c["spark.sql.files.maxPartitionBytes"].rstrip("m")) <= 256


def test_filter_slice(events_small):
    feed, _ = events_small
    ads = filter_slice(feed, source="ads", os=["iOS", "Android"], time_from="2024-01-10", time_to="2024-01-11")
    row = ads.agg(F.min("time").alias("lo"), F.max("time").alias("hi"),
                  F.count_if(F.col("source") != "ads").alias("bad")).first()
    assert row.bad == 0 and str(row.lo) >= "2024-01-10" and str(row.hi) < "2024-01-11"
