"""Ranges of prefix sums follow the data."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cohortia.functions.ranks import dense_index, exact_quantiles, prefix_sum, range_cuts, range_index


def _largest(df, col, buckets=256):
    per = df.groupBy(range_index(col, range_cuts(df, col, buckets)).alias("b")).count().collect()
    return max(r["count"] for r in per) / (sum(r["count"] for r in per) / buckets)


def test_largest_range_is_below_twice_the_mean(spark):
    ids = spark.range(1, 10_000_001)
    assert _largest(ids, "id") < 2
    skewed = spark.range(200_000).select(F.pow(F.lit(10.0), F.rand(3) * 12).alias("v"))
    assert _largest(skewed.unionByName(spark.createDataFrame([(1e300,), (-1e300,)], "v double")), "v") < 2


def test_index_counts_the_cuts(spark):
    cuts = F.lit([1.0, 2.0, 2.5, 9.0, 9.5])
    rows = spark.createDataFrame([(float(v),) for v in (-5, 0.99, 1, 1.5, 2, 2.4, 2.5, 8, 9, 9.4, 9.5, 1e9)], "v double")
    for r in rows.select("v", range_index("v", cuts).alias("i")).collect():
        assert r.i == sum(c <= r.v for c in (1.0, 2.0, 2.5, 9.0, 9.5))


def test_prefix_sums_equal_a_plain_scan(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), float(v), int(w)) for k in range(3) for v, w in zip(rng.permutation(900) ** 3 / 7 - 1e6, rng.integers(-5, 9, 900))]
    frame = spark.createDataFrame(rows, "k int, v double, w long").repartition(5)
    for keys in ((), ("k",)):
        use = frame if keys else frame.where("k = 0")
        got = {(r.k, r.v): r.cum_before for r in prefix_sum(use, "v", "w", keys, buckets=37).collect()}
        want = {}
        for k in (range(3) if keys else [0]):
            total = 0
            for _, v, w in sorted(r for r in rows if r[0] == k):
                want[k, v] = total
                total += w
        assert got == want
    big = spark.createDataFrame([(2 ** 62 + i, ) for i in range(50)], "v long")     # beyond what a double tells apart
    assert {r.v - 2 ** 62: r.idx for r in dense_index(big, "v", buckets=16).collect()} == {i: i for i in range(50)}
    assert prefix_sum(frame.limit(0), "v", "w").count() == 0
    q = exact_quantiles(frame, "v", [0.1, 0.5], ("k",), 16).collect()
    assert all(abs(r.quantile - np.quantile([v for k, v, _ in rows if k == r.k], r.prob)) < 1e-6 for r in q)
