"""Exact p-values of the U test against all orders of both samples."""

from __future__ import annotations

from itertools import combinations

import pytest

from cohortia.functions.stats import norm_sf
from cohortia.operators.experiment import mann_whitney


def _orders(n, m):
    return [sum(p) - n * (n - 1) // 2 for p in combinations(range(n + m), n)]


def test_exact_equals_enumeration(spark):
    cases = [(n, m, frozenset(p)) for n in range(1, 9) for m in (1, 2, 5, 8)
             for p in (list(combinations(range(n + m), n))[k] for k in (0, -1, len(_orders(n, m)) // 3))]
    rows = [(k, int(i not in places), float(i)) for k, (n, m, places) in enumerate(cases) for i in range(n + m)]
    frame = spark.createDataFrame(rows, "k int, g int, x double").repartition(4)
    got = {r.k: r for r in mann_whitney(frame, "x", "g", 0, 1, ("k",)).collect()}
    assert len(got) == len(cases)
    for k, (n, m, places) in enumerate(cases):
        us, u = _orders(n, m), sum(places) - n * (n - 1) // 2
        up, down = sum(x >= u for x in us) / len(us), sum(x <= u for x in us) / len(us)
        r = got[k]
        assert (r.n_a, r.n_b, r.u_a, r.exact) == (n, m, u, True)
        assert (r.p_greater, r.p_less, r.p_two_sided) == pytest.approx((up, down, min(1, 2 * min(up, down))))


def test_ties_size_and_missing_values(spark):
    rows = [("tie", g, float(i)) for g in (0, 1) for i in range(4)] + [("large", i % 2, i + 0.5 * (i % 2)) for i in range(18)]
    rows += [("none", 0, None), ("none", 1, 1.0), ("one", 0, 1.0), (None, 0, 1.0), (None, 1, 2.0), (None, 1, None)]
    got = {r.k: r for r in mann_whitney(spark.createDataFrame(rows, "k string, g int, x double"), "x", "g", 0, 1, ("k",)).collect()}
    assert not got["tie"].exact and got["tie"].tied and not got["large"].exact and not got["large"].tied
    assert got["large"].p_greater == pytest.approx(float(norm_sf(got["large"].z_greater)))
    assert not got["none"].exact and (got["none"].n_dropped_a, got["none"].n_dropped_b) == (1, 0)
    assert not got["one"].exact and got[None].exact and got[None].n_dropped_b == 1 and got[None].p_less == 0.5
    r, = mann_whitney(spark.createDataFrame(rows, "k string, g int, x double"), "x", "g", 0, 1).collect()
    assert (r.n_a, r.n_b, r.n_dropped_a, r.n_dropped_b) == (15, 15, 1, 1) and r.tied
