"""Robust decomposition: a planted outlier stays out of trend and season."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortia.operators.eda import robust_decompose

BEGIN = dt.datetime(2024, 3, 1)


def _series(spark, outlier=0.0, days=20, keys=("a", None)):
    rng = np.random.default_rng(4)
    rows = []
    for k in keys:
        for t in range(24 * days):
            y = 50 + 0.1 * t + 8 * math.sin(2 * math.pi * t / 24) + float(rng.normal())
            rows.append((k, BEGIN + dt.timedelta(hours=t), y + (outlier if t == 200 and k is None else 0)))
    return spark.createDataFrame(rows, "k string, day_h timestamp, actions double").repartition(4)


def _part(frame, name):
    return {(r.k, r.day_h): r[name] for r in frame.collect()}


def test_outlier_moves_the_season_little(spark):
    clean = robust_decompose(_series(spark), keys=("k",))
    hit = robust_decompose(_series(spark, 3000.0), keys=("k",))
    for name, bound in (("seasonal", 0.6), ("trend", 0.6)):
        a, b = _part(clean, name), _part(hit, name)
        assert a.keys() == b.keys() and len(a) == 960
        assert max(abs(a[x] - b[x]) for x in a if x[0] is None) < bound
        assert all(a[x] == pytest.approx(b[x]) for x in a if x[0] == "a")
    worst = hit.orderBy(F.desc(F.abs("resid"))).first()
    assert worst.day_h == BEGIN + dt.timedelta(hours=200) and worst.weight == 0 and abs(worst.resid - 3000) < 10


def test_parts_are_found(spark):
    got = robust_decompose(_series(spark, keys=("a",)), keys=("k",)).collect()
    inner = [r for r in got if 24 <= (r.day_h - BEGIN).total_seconds() / 3600 < 24 * 19]
    for r in inner:
        t = (r.day_h - BEGIN).total_seconds() / 3600
        assert abs(r.trend - 50 - 0.1 * t) < 1.5 and abs(r.seasonal - 8 * math.sin(2 * math.pi * t / 24)) < 3
        assert r.observed == pytest.approx(r.trend + r.seasonal + r.resid) and 0 <= r.weight <= 1


def test_gaps_repeats_and_empty_series(spark):
    rows = [(BEGIN, 2), (BEGIN, 3), (BEGIN + dt.timedelta(hours=50), None), (None, 9)]
    frame = spark.createDataFrame(rows, "day_h timestamp, actions int")
    got = robust_decompose(frame).orderBy("day_h").collect()
    assert [r.observed for r in got] == [5.0] + [0.0] * 50 and all(math.isfinite(r.trend + r.seasonal) for r in got)
    assert robust_decompose(frame.limit(0)).count() == 0
