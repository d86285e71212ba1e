"""Bootstrap by cells: sizes of pieces, moments of the weights, agreement with the bootstrap by users."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from cohortia.functions.hashing import DRAWS, poisson_table, poisson_thresholds
from cohortia.operators import experiment as ex


def _users(spark, sizes):
    cells = spark.createDataFrame([(g, li, v, n) for (g, li, v), n in sizes.items()], "exp_group int, likes long, views long, n long")
    return cells.select("exp_group", "likes", "views", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i")).select(
        "exp_group", "likes", "views", F.concat_ws("-", "likes", "views", "i").alias("user_id"))


SIZES = {(1, 1, 4): 1, (1, 2, 5): 37, (1, 3, 9): 9000, (2, 0, 7): 4096, (2, 5, 6): 4095, (2, 1, 0): 12289, (3, 1, 1): 50}


def test_pieces_add_up_to_the_cells(spark):
    p = ex.bootstrap_pieces(_users(spark, SIZES), 1, 2)
    got = {(r.exp_group, r.likes, r.views): (r.users, r.pieces) for r in p.groupBy("exp_group", "likes", "views").agg(
        F.sum(F.expr("shiftleft(1L, bits)")).alias("users"), F.count_distinct("bits", "copy").alias("pieces")).collect()}
    expected = {k: (n, n // 4096 + bin(n % 4096).count("1")) for k, n in SIZES.items() if k[0] != 3}
    assert got == expected


def test_rows_follow_cells(spark):
    # the stated bound: 12 pieces a cell and one for each 4,096 users
    for times in (1, 10):
        sizes = {k: times * n for k, n in SIZES.items() if k[0] != 3}
        assert ex.bootstrap_pieces(_users(spark, sizes), 1, 2).count() <= sum(12 + n / 4096 for n in sizes.values())


def test_weights_have_poisson_moments(spark):
    # with one like a user and one view in the whole group, a replicate's CTR is its weighted likes
    n, reps = 9001, 4000
    users = _users(spark, {(1, 1, 1): n, (2, 0, 1): 1, (2, 1, 0): n})
    w = np.array([r.lt for r in _weights(spark, users, reps)], float)
    assert abs(w.mean() - n) < 5 * math.sqrt(n / reps)
    assert abs(w.var() / n - 1) < 5 * math.sqrt(2 / reps)
    assert w.max() > n + 2.5 * math.sqrt(n) and w.min() < n - 2.5 * math.sqrt(n)


def _weights(spark, users, reps):
    import unittest.mock as mock
    with mock.patch.object(ex, "_replicate_ctr", lambda r, c, t: r.where("exp_group = 2 and likes = 1").groupBy("replicate").agg(F.sum("w").alias("lt"))):
        return ex.poisson_bootstrap_cells(users, 1, 2, reps).collect()


def test_table_is_the_inverse_cdf():
    low, t = poisson_table(64)
    full = poisson_thresholds(64)
    for x in (1, 2, DRAWS // 1000, DRAWS // 2, DRAWS - 1):
        assert low + sum(v <= x for v in t) == sum(v <= x for v in full)
    assert t == sorted(t) and t[-1] < DRAWS


def test_same_spread_as_by_users(spark):
    users = _users(spark, {(1, i % 5, 10 + i % 7): 3 for i in range(35)} | {(2, i % 4, 9 + i % 5): 4 for i in range(20)})
    a = ex.poisson_bootstrap(users, 1, 2, 3000, seed=3).toPandas()
    b = ex.poisson_bootstrap_cells(users, 1, 2, 3000, seed=3).toPandas()
    assert len(a) == len(b) == 3000
    for col in ("ctr_control", "ctr_test", "diff"):
        assert abs(a[col].mean() - b[col].mean()) < 5 * a[col].std() / math.sqrt(1500)
        assert 0.9 < a[col].std() / b[col].std() < 1.1
    assert ex.poisson_bootstrap_cells(users.limit(0), 1, 2, 10).count() == 0
