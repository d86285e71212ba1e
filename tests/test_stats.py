"""Statistics against independent implementations (numpy brute force, commons-math3)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortia.functions import stats
from cohortia.functions.hashing import poisson_thresholds
from cohortia.operators import experiment as ex


@pytest.mark.parametrize("t,dof", [(0.0, 5.0), (1.3, 3.0), (-2.2, 12.5), (4.0, 80.0), (0.5, 1.0), (-7.0, 250.0),
                                   (0.1, 0.7), (2.5, 0.7), (1.0, 99_999.0)])
def test_t_distribution_matches_commons_math(spark, t, dof):
    jvm = spark.sparkContext._jvm
    cdf = jvm.org.apache.commons.math3.distribution.TDistribution(float(dof)).cumulativeProbability(float(t))
    assert stats.t_sf(np.array([t]), np.array([dof]))[0] == pytest.approx(1 - cdf, abs=1e-10)


def _tail_by_quadrature(t, dof):
    """∫ cos^(df−1) θ dθ over the tail, as a share of the whole, by Gauss–Legendre in 400
    pieces; for df ≥ 1, as there is a pole at the end below."""
    x, w = np.polynomial.legendre.leggauss(20)

    def integral(lo, hi):
        cuts = np.linspace(lo, hi, 401)
        mid, half = (cuts[1:] + cuts[:-1]) / 2, (cuts[1:] - cuts[:-1]) / 2
        return float(np.sum(half[:, None] * w * np.exp((dof - 1) * np.log(np.cos(mid[:, None] + half[:, None] * x)))))

    start = math.atan(t / math.sqrt(dof))
    far = min(math.pi / 2, start + 60 / math.sqrt(dof))
    return integral(start, far) / (2 * integral(0.0, min(math.pi / 2, 60 / math.sqrt(dof))))


@pytest.mark.parametrize("dof", [1.0, 3.0, 49.0, 101.0, 1e3, 99_999.0, 100_001.0, 1e7, 1e9])
@pytest.mark.parametrize("t", [0.0, 0.1, 1.0, 2.5, 6.0])
def test_t_tail_by_quadrature_for_any_degrees_of_freedom(t, dof):
    got = stats.t_sf(np.array([t, -t]), np.array([dof, dof]))
    assert got[0] == pytest.approx(_tail_by_quadrature(t, dof), rel=1e-8)
    assert got.sum() == pytest.approx(1.0, abs=1e-12)


def test_log_beta_keeps_its_digits():
    a = np.array([0.5, 3.0, 49.9, 50.1, 1e4, 1e9])
    # B(a, 1) = 1/a and B(a, 2) = 1/(a (a + 1))
    assert stats.log_beta(a, np.ones(6)) == pytest.approx(-np.log(a), rel=1e-13, abs=1e-13)
    assert stats.log_beta(np.full(6, 2.0), a) == pytest.approx(-np.log(a) - np.log1p(a), rel=1e-13, abs=1e-13)


def test_no_convergence_is_an_error():
    with pytest.raises(ArithmeticError):
        stats._betacf(np.array([1e6]), np.array([0.5]), np.array([0.9999]), iters=3)


@pytest.mark.parametrize("z", [-3.0, -0.4, 0.0, 1.7, 5.0])
def test_normal_tail_matches_commons_math(spark, z):
    jvm = spark.sparkContext._jvm
    cdf = jvm.org.apache.commons.math3.distribution.NormalDistribution(0.0, 1.0).cumulativeProbability(z)
    assert stats.norm_sf(np.array([z]))[0] == pytest.approx(1 - cdf, abs=1e-12)


def _jarr(sc, xs):
    arr = sc._gateway.new_array(sc._jvm.double, len(xs))
    for i, v in enumerate(xs):
        arr[i] = float(v)
    return arr


def _frame(spark, a, b):
    pdf = pd.DataFrame({"g": [1] * len(a) + [2] * len(b), "x": list(a) + list(b)})
    return spark.createDataFrame(pdf)


def test_welch_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0.3, 1.0, 57), rng.normal(0.0, 2.0, 91)
    row = ex.welch_ttest(_frame(spark, a, b), "x", "g", 1, 2).first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert row.t == pytest.approx(t, rel=1e-10)
    assert row.df == pytest.approx(dof, rel=1e-10)
    sc = spark.sparkContext
    p = sc._jvm.org.apache.commons.math3.stat.inference.TTest().tTest(_jarr(sc, a), _jarr(sc, b))
    assert row.p_two_sided == pytest.approx(p, rel=1e-8)
    assert row.p_greater + row.p_less == pytest.approx(1.0, abs=1e-12)


def test_mann_whitney_u_matches_rank_sum_with_ties(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 20, 300).astype(float)
    b = rng.integers(3, 25, 250).astype(float)
    row = ex.mann_whitney(_frame(spark, a, b), "x", "g", 1, 2).first()
    allv = np.concatenate([a, b])
    ranks = pd.Series(allv).rank().to_numpy()
    u1 = ranks[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    assert row.u_a == pytest.approx(u1)
    assert row.u_a + row.u_b == pytest.approx(len(a) * len(b))
    _, counts = np.unique(allv, return_counts=True)
    n = len(allv)
    sigma = math.sqrt(len(a) * len(b) / 12 * ((n + 1) - (counts ** 3 - counts).sum() / (n * (n - 1))))
    assert row.sigma == pytest.approx(sigma)
    z = (max(u1, len(a) * len(b) - u1) - len(a) * len(b) / 2 - 0.5) / sigma
    assert row.p_two_sided == pytest.approx(min(1.0, 2 * 0.5 * math.erfc(z / math.sqrt(2))))


def test_prefix_sum_many_buckets_equals_cumsum(spark):
    from cohortia.functions.ranks import dense_index, prefix_sum
    pdf = pd.DataFrame({"k": np.repeat([0, 1], 500), "v": np.concatenate([np.arange(500) ** 2,
                                                                          np.arange(500) * -3.5]),
                        "w": np.arange(1000) % 7})
    out = prefix_sum(spark.createDataFrame(pdf), "v", "w", ("k",), buckets=16).toPandas()
    for k, g in out.groupby("k"):
        g = g.sort_values("v")
        assert (g["cum_before"].to_numpy() == (g["w"].cumsum() - g["w"]).to_numpy()).all()
    idx = dense_index(spark.createDataFrame(pdf), "v", ("k",), buckets=8).toPandas()
    for _, g in idx.groupby("k"):
        assert sorted(g["idx"]) == list(range(len(g)))
        assert (g.sort_values("v")["idx"].to_numpy() == np.arange(len(g))).all()


def test_exact_quantiles_match_pandas(spark):
    from cohortia.functions.ranks import exact_quantiles
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 2000), "v": rng.integers(0, 40, 2000).astype(float)})
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), "v", probs, ("k",), buckets=5).toPandas()
    for (k, p), q in got.set_index(["k", "prob"])["quantile"].items():
        assert q == pytest.approx(pdf[pdf.k == k].v.quantile(p))


def test_poisson_weights_have_poisson_moments(spark):
    from cohortia.functions.hashing import draw, draw_state, poisson_weight
    df = (spark.range(200000).select(draw_state(11, F.col("id")).alias("s"))
          .select(draw(F.col("s"), F.lit(3)).alias("x")).select(poisson_weight(F.col("x")).alias("w")))
    m = df.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"),
               F.avg((F.col("w") == 0).cast("double")).alias("p0")).first()
    assert m.m == pytest.approx(1.0, abs=0.01)
    assert m.v == pytest.approx(1.0, abs=0.02)
    assert m.p0 == pytest.approx(math.exp(-1), abs=0.005)


def test_poisson_weight_has_no_cap(spark):
    from cohortia.functions.hashing import DRAWS, poisson_weight
    t = poisson_thresholds()
    assert t[0] / DRAWS == pytest.approx(math.exp(-1), abs=1e-15)
    assert len(t) > 15 and t == sorted(set(t)) and t[-1] < DRAWS
    rows = spark.createDataFrame([(0,), (t[0] - 1,), (t[0],), (t[9],), (t[-1] - 1,), (t[-1],), (DRAWS - 1,)], "x long")
    got = [r.w for r in rows.select(poisson_weight(F.col("x")).alias("w")).collect()]
    assert got == [0, 0, 1, 10, len(t) - 1, len(t), len(t)]


def test_draw_index_reaches_all_of_a_pool_above_31_bits(spark):
    from cohortia.functions.hashing import draw, draw_index, draw_state
    size = 3 * 2 ** 31
    x = (spark.range(20).select(draw_state(1, F.col("id")).alias("s"))
         .select(F.explode(F.sequence(F.lit(0), F.lit(4999))).alias("k"), "s").select(draw(F.col("s"), F.col("k")).alias("x")))
    third = x.select(F.floor(draw_index(F.col("x"), F.lit(size)) / 2 ** 31).alias("third"))
    share = {r.third: r["count"] / 100_000 for r in third.groupBy("third").count().collect()}
    assert set(share) == {0, 1, 2} and all(abs(v - 1 / 3) < 0.01 for v in share.values())
    assert x.distinct().count() == 100_000


def test_aa_pooled_false_positive_rate_near_alpha(spark, events_small):
    feed, _ = events_small
    users = ex.experiment_user_metrics(feed, "2024-01-01", "2024-01-30", (2, 3))
    sims = ex.aa_simulation(spark, users, 2, 3, "ctr", 2000, 200, "pooled", 5)
    share = ex.aa_summary(sims).select("share_le_alpha_pct").first()[0]
    assert 3.0 <= share <= 7.5


def _brute_tau_b(x, y):
    m = ~(np.isnan(x) | np.isnan(y))
    x, y = x[m], y[m]
    dx = np.sign(x[:, None] - x[None, :])
    dy = np.sign(y[:, None] - y[None, :])
    iu = np.triu_indices(len(x), 1)
    return (dx * dy)[iu].sum() / np.sqrt((dx != 0)[iu].sum() * (dy != 0)[iu].sum())


def test_kendall_tau_b_matches_brute_force_with_ties_and_nulls(spark):
    from cohortia.operators.eda import kendall_matrix
    rng = np.random.default_rng(0)
    n = 1500
    pdf = pd.DataFrame({"a": rng.integers(0, 40, n).astype(float), "b": rng.integers(0, 9, n).astype(float)})
    pdf["c"] = pdf.a * 0.5 + rng.normal(0, 4, n).round()
    pdf.loc[::13, "c"] = None
    got = kendall_matrix(spark.createDataFrame(pdf), ["a", "b", "c"]).toPandas()
    assert len(got) == 9
    for r in got.itertuples():
        ref = _brute_tau_b(pdf[r.x_col].to_numpy(float), pdf[r.y_col].to_numpy(float))
        assert r.tau == pytest.approx(ref, abs=1e-12)


@pytest.mark.parametrize("null", ["per_group", "pooled"])
def test_aa_join_never_broadcasts_the_pool_or_the_draws(spark, events_small, null):
    feed, _ = events_small
    users = ex.experiment_user_metrics(feed, "2024-01-01", "2024-01-30", (2, 3))
    sims = ex.aa_simulation(spark, users, 2, 3, "ctr", 300, 50, null, 1)
    assert "ShuffledHashJoin" in sims._jdf.queryExecution().executedPlan().toString()
    got = sims.toPandas()
    assert len(got) == 300 and (got.n_a == 50).all() and (got.n_b == 50).all()


def test_kendall_integer_and_mixed_columns_match_brute_force(spark):
    from cohortia.operators.eda import kendall_matrix
    rng = np.random.default_rng(5)
    n = 1200
    pdf = pd.DataFrame({"i": rng.integers(-30, 2000, n), "j": rng.integers(0, 7, n)})
    pdf["d"] = pdf.i * 0.01 + rng.normal(0, 3, n).round(1)
    sdf = spark.createDataFrame(pdf).selectExpr("CAST(i AS BIGINT) AS i", "CAST(j AS INT) AS j", "d")
    got = kendall_matrix(sdf, ["d", "i", "j"]).toPandas()
    for r in got.itertuples():
        ref = _brute_tau_b(pdf[r.x_col].to_numpy(float), pdf[r.y_col].to_numpy(float))
        assert r.tau == pytest.approx(ref, abs=1e-12)
