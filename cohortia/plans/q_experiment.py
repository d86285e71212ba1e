"""Registered experiment queries."""

from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction

from pyspark.sql import functions as F

from cohortia.functions.hashing import md5_bucket_sql
from cohortia.operators import experiment as ex
from cohortia.plans.catalog import register
from cohortia.sources.events import load_events

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
AB = (1, 2)          # control, test (A/B file)
LIN = (0, 3)         # control, test (linearized-likes file)
AA = (2, 3)          # the two A/A groups
N_BOOT, N_TESTS, N_SAMPLES, SEED = 2000, 10000, 500, 0


def _users_sql(groups: tuple[int, ...]) -> str:
    g = ", ".join(str(x) for x in groups)
    return f"""
SELECT exp_group, user_id,
       count(*) FILTER (WHERE action = 'like') AS likes,
       count(*) FILTER (WHERE action = 'view') AS views,
       CAST(count(*) FILTER (WHERE action = 'like') AS DOUBLE)
         / nullif(count(*) FILTER (WHERE action = 'view'), 0) AS ctr,
       count(DISTINCT post_id) AS posts
FROM feed_actions
WHERE CAST(time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' AND exp_group IN ({g})
GROUP BY exp_group, user_id"""


def _smoothed_sql(groups, alpha: float = 5.0) -> str:
    return f"""
WITH u AS ({_users_sql(groups)}),
g AS (SELECT exp_group, CAST(sum(likes) AS DOUBLE) / nullif(sum(views), 0) AS gc FROM u GROUP BY exp_group)
SELECT u.*, (u.likes + {alpha} * g.gc) / (u.views + {alpha}) AS smoothed_ctr
FROM u JOIN g ON u.exp_group = g.exp_group"""


def _linearized_sql(control: int, groups) -> str:
    return f"""
WITH u AS ({_users_sql(groups)})
SELECT u.*, u.likes - (SELECT CAST(sum(likes) AS DOUBLE) / nullif(sum(views), 0) FROM u
                       WHERE exp_group = {control}) * u.views AS linearized_likes
FROM u"""


def _buckets_sql(groups, n: int = 50) -> str:
    return f"""
WITH u AS ({_users_sql(groups)})
SELECT exp_group, {md5_bucket_sql('user_id', n)} AS bucket, count(*) AS users,
       CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
       CAST(sum(likes) AS DOUBLE) / nullif(sum(views), 0) AS bucket_ctr
FROM u GROUP BY 1, 2"""


def _welch_sql(src: str, value: str, a, b) -> str:
    return f"""
WITH d AS ({src}),
s AS (SELECT count({value}) FILTER (WHERE exp_group = {a}) AS n_a,
             count({value}) FILTER (WHERE exp_group = {b}) AS n_b,
             count(*) FILTER (WHERE exp_group = {a} AND {value} IS NULL) AS n_dropped_a,
             count(*) FILTER (WHERE exp_group = {b} AND {value} IS NULL) AS n_dropped_b,
             avg({value}) FILTER (WHERE exp_group = {a}) AS mean_a,
             avg({value}) FILTER (WHERE exp_group = {b}) AS mean_b,
             var_samp({value}) FILTER (WHERE exp_group = {a}) AS var_a,
             var_samp({value}) FILTER (WHERE exp_group = {b}) AS var_b
      FROM d)
SELECT '{a}' AS group_a, '{b}' AS group_b, *,
       (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
       (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
         / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df
FROM s"""


def _mw_sql(src: str, value: str, a, b) -> str:
    return f"""
WITH d AS ({src}),
c AS (SELECT {value} AS v, count(*) FILTER (WHERE exp_group = {a}) AS n1,
             count(*) FILTER (WHERE exp_group = {b}) AS n2
      FROM d WHERE {value} IS NOT NULL AND exp_group IN ({a}, {b}) GROUP BY 1),
cc AS (SELECT *, coalesce(sum(n2) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c2
       FROM c),
s AS (SELECT CAST(sum(n1) AS BIGINT) AS n_a, CAST(sum(n2) AS BIGINT) AS n_b,
             sum(n1 * (CAST(c2 AS DOUBLE) + CAST(n2 AS DOUBLE) / 2)) AS u_a,
             sum(power(CAST(n1 + n2 AS DOUBLE), 3) - (n1 + n2)) AS tie_term FROM cc),
m AS (SELECT '{a}' AS group_a, '{b}' AS group_b, n_a, n_b, u_a,
             CAST(n_a AS DOUBLE) * n_b - u_a AS u_b, CAST(n_a AS DOUBLE) * n_b / 2 AS mu,
             sqrt(CAST(n_a AS DOUBLE) * n_b / 12 * ((n_a + n_b + 1)
                  - tie_term / (CAST(n_a + n_b AS DOUBLE) * (n_a + n_b - 1)))) AS sigma FROM s)
SELECT *, (u_a - mu - 0.5) / sigma AS z_greater, (u_b - mu - 0.5) / sigma AS z_less,
       (greatest(u_a, u_b) - mu - 0.5) / sigma AS z_two_sided FROM m"""


# Tails by Simpson's rule in an even number of steps.  With T = √df · tan θ Student's density becomes
# cos^(df−1) θ on (−π/2, π/2), whose whole integral is √π Γ(df/2) / Γ((df+1)/2).
_STEPS = 1000


def _simpson_sql(density: str, upper: str) -> str:
    """∫₀^upper of ``density``, an expression of the lambda's place ``p``."""
    weight = f"CASE WHEN i IN (0, {_STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    at = density.replace("{p}", f"({upper} * i / {_STEPS})")
    return f"({upper} / {3 * _STEPS} * list_sum(list_transform(range({_STEPS + 1}), lambda i: {weight} * {at})))"


def _t_sf_sql(t: str, dof: str) -> str:
    """P(T > t)."""
    whole = f"(sqrt(pi()) * exp(lgamma({dof} / 2) - lgamma(({dof} + 1) / 2)))"
    return f"abs(0.5 - {_simpson_sql(f'power(cos({{p}}), {dof} - 1)', f'atan({t} / sqrt({dof}))')} / {whole})"


def _norm_sf_sql(z: str) -> str:
    """P(Z > z)."""
    return f"abs(0.5 - {_simpson_sql('exp(-{p} * {p} / 2)', z)} / sqrt(2 * pi()))"


_W = ("mean_a", "mean_b", "var_a", "var_b", "t", "df")
_U = ("u_a", "u_b", "mu", "sigma", "z_greater", "z_less", "z_two_sided")


def _users(spark, d, groups):
    f, _ = load_events(spark, d)
    return ex.experiment_user_metrics(f, START, END, groups)


@register("experiment_user_metrics", _users_sql(AB), doubles=("ctr",))
def q_experiment_user_metrics(spark, d):
    return _users(spark, d, AB)


@register("smoothed_ctr", _smoothed_sql(AB), doubles=("ctr", "smoothed_ctr"))
def q_smoothed_ctr(spark, d):
    return ex.smoothed_ctr(_users(spark, d, AB), 5.0)


@register("linearized_likes", _linearized_sql(LIN[0], LIN), doubles=("ctr", "linearized_likes"))
def q_linearized_likes(spark, d):
    return ex.linearized_likes(_users(spark, d, LIN), LIN[0])


@register("bucket_ctr", _buckets_sql(AB), doubles=("bucket_ctr",))
def q_bucket_ctr(spark, d):
    f, _ = load_events(spark, d)
    return ex.bucket_ctr(f, START, END, AB, 50)


@register("welch_ttest_ctr", _welch_sql(_users_sql(AB), "ctr", AB[1], AB[0]), doubles=_W)
def q_welch_ttest_ctr(spark, d):
    return ex.welch_stats(_users(spark, d, AB), "ctr", "exp_group", AB[1], AB[0])


@register("welch_ttest_smoothed", _welch_sql(_smoothed_sql(AB), "smoothed_ctr", AB[1], AB[0]),
          doubles=_W)
def q_welch_ttest_smoothed(spark, d):
    return ex.welch_stats(ex.smoothed_ctr(_users(spark, d, AB)), "smoothed_ctr", "exp_group",
                          AB[1], AB[0])


@register("welch_ttest_linearized",
          _welch_sql(_linearized_sql(LIN[0], LIN), "linearized_likes", LIN[0], LIN[1]), doubles=_W)
def q_welch_ttest_linearized(spark, d):
    return ex.welch_stats(ex.linearized_likes(_users(spark, d, LIN), LIN[0]), "linearized_likes",
                          "exp_group", LIN[0], LIN[1])


@register("welch_ttest_buckets", _welch_sql(_buckets_sql(AB), "bucket_ctr", AB[1], AB[0]), doubles=_W)
def q_welch_ttest_buckets(spark, d):
    f, _ = load_events(spark, d)
    return ex.welch_stats(ex.bucket_ctr(f, START, END, AB, 50), "bucket_ctr", "exp_group", AB[1], AB[0])


@register("mann_whitney_ctr", _mw_sql(_users_sql(AB), "ctr", AB[1], AB[0]), doubles=_U)
def q_mann_whitney_ctr(spark, d):
    return ex.mann_whitney_stats(_users(spark, d, AB), "ctr", "exp_group", AB[1], AB[0])


@register("mann_whitney_smoothed", _mw_sql(_smoothed_sql(AB), "smoothed_ctr", AB[1], AB[0]), doubles=_U)
def q_mann_whitney_smoothed(spark, d):
    return ex.mann_whitney_stats(ex.smoothed_ctr(_users(spark, d, AB)), "smoothed_ctr", "exp_group",
                                 AB[1], AB[0])


@register("mann_whitney_posts", _mw_sql(_users_sql(AB), "posts", AB[1], AB[0]), doubles=_U)
def q_mann_whitney_posts(spark, d):
    return ex.mann_whitney_stats(_users(spark, d, AB), "posts", "exp_group", AB[1], AB[0])


# Small tie-free samples: mean second of the day of each user's feed actions, by country and city.
_SECONDS_SQL = f"""
SELECT country, city, exp_group, user_id, avg(hour(time) * 3600 + minute(time) * 60 + second(time)) AS seconds
FROM feed_actions WHERE CAST(time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' AND exp_group IN ({AB[0]}, {AB[1]})
GROUP BY country, city, exp_group, user_id"""


@register("mann_whitney_exact", f"""
WITH d AS ({_SECONDS_SQL}),
pairs AS (SELECT x.country, x.city, count(*) FILTER (WHERE x.seconds > y.seconds) + count(*) FILTER (WHERE x.seconds = y.seconds) / 2 AS u_a
          FROM d x JOIN d y ON x.country = y.country AND x.city = y.city AND x.exp_group = {AB[1]} AND y.exp_group = {AB[0]}
          GROUP BY x.country, x.city),
k AS (SELECT country, city, count(*) FILTER (WHERE exp_group = {AB[1]}) AS n_a, count(*) FILTER (WHERE exp_group = {AB[0]}) AS n_b,
             count(DISTINCT seconds) < count(*) AS tied FROM d GROUP BY country, city),
s AS (SELECT k.*, coalesce(u_a, 0.0) AS u_a FROM k LEFT JOIN pairs USING (country, city)),
sizes AS (SELECT DISTINCT n_a, n_b FROM s WHERE NOT tied AND n_a BETWEEN 1 AND 8 AND n_b BETWEEN 1 AND 8),
-- every order of two samples is a set of places of the first: U counts the places before them that it leaves free
orders AS (SELECT n_a, n_b, list_sum(list_transform(range(n_a + n_b), lambda i: i * ((x >> i) & 1))) - n_a * (n_a - 1) // 2 AS u
           FROM sizes, range(65536) AS t(x) WHERE x < (1 << (n_a + n_b)) AND bit_count(x) = n_a),
share AS (SELECT s.country, s.city, avg(CAST(u >= u_a AS DOUBLE)) AS up, avg(CAST(u <= u_a AS DOUBLE)) AS down
          FROM s JOIN orders USING (n_a, n_b) WHERE NOT tied GROUP BY s.country, s.city)
SELECT s.country, s.city, n_a, n_b, u_a, tied, up AS exact_greater, down AS exact_less,
       CASE WHEN up IS NOT NULL THEN least(1.0, 2 * least(up, down)) END AS exact_two_sided
FROM s LEFT JOIN share USING (country, city)""", doubles=("u_a", "exact_greater", "exact_less", "exact_two_sided"))
def q_mann_whitney_exact(spark, d):
    f, _ = load_events(spark, d)
    f = f.where(F.to_date("time").between(F.lit(START), F.lit(END)) & F.col("exp_group").isin(*AB))
    users = f.groupBy("country", "city", "exp_group", "user_id").agg(
        F.avg(F.hour("time") * 3600 + F.minute("time") * 60 + F.second("time")).alias("seconds"))
    stats = ex.mann_whitney_stats(users, "seconds", "exp_group", AB[1], AB[0], ("country", "city"), details=True)
    return ex.with_exact_u_pvalues(stats).select("country", "city", "n_a", "n_b", "u_a", "tied", "exact_greater", "exact_less",
                                                 "exact_two_sided")


# The draws once more, from their definition: p is the prime, d the number of draws.
_P, _D = 2 ** 31 - 1, (2 ** 31 - 1) ** 2


def _states_sql(*keys: str) -> str:
    text = f"md5(concat_ws('|', '{SEED}', " + ", ".join(keys) + "))"
    return ", ".join(f"('0x' || substr({text}, {at}, 8))::BIGINT % {_P} AS {name}"
                     for at, name in ((1, "s1"), (9, "s2")))


def _draw_sql(key: str) -> str:
    def stream(state: str, start: int, first: int, second: int, last: int) -> str:
        x = f"(({state} + {key} * {start}) % {_P} * {first} % {_P})"
        x = f"(xor({x}, {x} >> 15) * {second} % {_P})"
        return f"(xor({x}, {x} >> 13) * {last} % {_P})"
    return f"{stream('s1', 16807, 69621, 40692, 48271)} * {_P} + {stream('s2', 48271, 40692, 16807, 69621)}"


def _poisson_sql(u: str) -> str:
    """#{k: u ≥ Σ_{j≤k} 1/(e·j!)} of a uniform ``u`` in [0, 1)."""
    below = [sum(Fraction(1, math.factorial(j)) for j in range(k + 1)) for k in range(18)]
    cases = " ".join(f"WHEN {u} < {float(b) / math.e!r} THEN {k}" for k, b in enumerate(below))
    return f"CASE {cases} ELSE 18 END"


def _bootstrap_sql() -> str:
    c, t = AB
    return f"""
WITH u AS ({_users_sql(AB)}),
v AS (SELECT exp_group, likes, views, {_states_sql("exp_group", "user_id")} FROM u),
x AS (SELECT v.exp_group, v.likes, v.views, g.replicate, CAST({_draw_sql("g.replicate")} AS DOUBLE) / {_D} AS x
      FROM v, (SELECT CAST(range AS INTEGER) AS replicate FROM range(1, {N_BOOT + 1})) g),
r AS (SELECT exp_group, likes, views, replicate, {_poisson_sql("x")} AS w FROM x),
s AS (SELECT replicate,
             sum(w * likes) FILTER (WHERE exp_group = {c}) AS lc, sum(w * views) FILTER (WHERE exp_group = {c}) AS vc,
             sum(w * likes) FILTER (WHERE exp_group = {t}) AS lt, sum(w * views) FILTER (WHERE exp_group = {t}) AS vt
      FROM r GROUP BY replicate)
SELECT replicate, CAST(lc AS DOUBLE) / nullif(vc, 0) AS ctr_control,
       CAST(lt AS DOUBLE) / nullif(vt, 0) AS ctr_test,
       CAST(lt AS DOUBLE) / nullif(vt, 0) - CAST(lc AS DOUBLE) / nullif(vc, 0) AS diff
FROM s"""


@register("poisson_bootstrap", _bootstrap_sql(), doubles=("ctr_control", "ctr_test", "diff"))
def q_poisson_bootstrap(spark, d):
    return ex.poisson_bootstrap(_users(spark, d, AB), AB[0], AB[1], N_BOOT, SEED)


@register("bootstrap_summary", f"""
WITH b AS ({_bootstrap_sql()})
SELECT avg(ctr_control) AS mean_control, avg(ctr_test) AS mean_test,
       median(ctr_control) AS median_control, median(ctr_test) AS median_test,
       quantile_cont(diff, 0.025) AS diff_lo, quantile_cont(diff, 0.975) AS diff_hi,
       avg(CAST(diff > 0 AS DOUBLE)) AS share_diff_positive, count(*) AS n_bootstrap
FROM b""", doubles=("mean_control", "mean_test", "median_control", "median_test", "diff_lo",
                    "diff_hi", "share_diff_positive"))
def q_bootstrap_summary(spark, d):
    return ex.bootstrap_summary(ex.poisson_bootstrap(_users(spark, d, AB), AB[0], AB[1], N_BOOT, SEED))


def _cells_sql() -> str:
    c, t = AB
    top = 2 ** ex.PIECE_BITS
    return f"""
WITH u AS ({_users_sql(AB)}),
cells AS (SELECT exp_group, likes, views, count(*) AS n FROM u GROUP BY ALL),
pieces AS (SELECT exp_group, likes, views, b AS bits, 0 AS copy FROM cells, range({ex.PIECE_BITS}) AS s(b) WHERE (n >> b) & 1 = 1
           UNION ALL SELECT exp_group, likes, views, {ex.PIECE_BITS}, unnest(range(1, n // {top} + 1)) FROM cells),
-- the distribution of a piece, up to 12 deviations and 30 beyond its mean
pmf AS (SELECT bits, k, exp(k * ln(1 << bits) - (1 << bits) - lgamma(k + 1)) AS p
        FROM (SELECT DISTINCT bits FROM pieces), range({top + 12 * 64 + 30}) AS s(k) WHERE k < (1 << bits) + 12 * sqrt(1 << bits) + 30),
cdf AS (SELECT bits, k, coalesce(sum(p) OVER (PARTITION BY bits ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS below
        FROM pmf),
v AS (SELECT *, {_states_sql("exp_group", "likes", "views", "bits", "copy")} FROM pieces),
x AS (SELECT v.exp_group, v.likes, v.views, v.bits, g.replicate, CAST({_draw_sql("g.replicate")} AS DOUBLE) / {_D} AS x
      FROM v, (SELECT CAST(range AS INTEGER) AS replicate FROM range(1, {N_BOOT + 1})) g),
r AS (SELECT x.*, cdf.k AS w FROM x ASOF JOIN cdf ON x.bits = cdf.bits AND x.x >= cdf.below),
s AS (SELECT replicate,
             sum(w * likes) FILTER (WHERE exp_group = {c}) AS lc, sum(w * views) FILTER (WHERE exp_group = {c}) AS vc,
             sum(w * likes) FILTER (WHERE exp_group = {t}) AS lt, sum(w * views) FILTER (WHERE exp_group = {t}) AS vt
      FROM r GROUP BY replicate)
SELECT replicate, CAST(lc AS DOUBLE) / nullif(vc, 0) AS ctr_control, CAST(lt AS DOUBLE) / nullif(vt, 0) AS ctr_test,
       CAST(lt AS DOUBLE) / nullif(vt, 0) - CAST(lc AS DOUBLE) / nullif(vc, 0) AS diff
FROM s"""


@register("poisson_bootstrap_cells", _cells_sql(), doubles=("ctr_control", "ctr_test", "diff"))
def q_poisson_bootstrap_cells(spark, d):
    return ex.poisson_bootstrap_cells(_users(spark, d, AB), AB[0], AB[1], N_BOOT, SEED)


def _aa_sql(null: str) -> str:
    a, b = AA
    pool_expr = "0" if null == "pooled" else f"CASE WHEN exp_group = {a} THEN 0 ELSE 1 END"
    draw_pool = "0" if null == "pooled" else "sample"
    return f"""
WITH u AS ({_users_sql(AA)}),
p0 AS (SELECT {pool_expr} AS pool, user_id, ctr AS x FROM u WHERE ctr IS NOT NULL),
pool AS (SELECT pool, x, row_number() OVER (PARTITION BY pool ORDER BY user_id) - 1 AS idx FROM p0),
sizes AS (SELECT pool, count(*) AS size FROM pool GROUP BY pool),
d AS (SELECT s.range AS sim, smp.sample, {_states_sql("s.range", "smp.sample")}
      FROM range(0, {N_TESTS}) s, (VALUES (0), (1)) smp(sample)),
dd AS (SELECT sim, sample, {draw_pool} AS pool, {_draw_sql("k.range")} AS h FROM d, range(0, {N_SAMPLES}) k),
picked AS (SELECT dd.sim, dd.sample, pool.x FROM dd JOIN sizes ON dd.pool = sizes.pool
           JOIN pool ON pool.pool = dd.pool AND pool.idx = dd.h % sizes.size),
st AS (SELECT sim, count(x) FILTER (WHERE sample = 0) AS n_a, count(x) FILTER (WHERE sample = 1) AS n_b,
              avg(x) FILTER (WHERE sample = 0) AS mean_a, avg(x) FILTER (WHERE sample = 1) AS mean_b,
              var_samp(x) FILTER (WHERE sample = 0) AS var_a, var_samp(x) FILTER (WHERE sample = 1) AS var_b
       FROM picked GROUP BY sim)
SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
       (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
         / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df
FROM st"""


@register("aa_simulation", _aa_sql("per_group"), doubles=_W)
def q_aa_simulation(spark, d):
    return ex.aa_simulation(spark, _users(spark, d, AA), AA[0], AA[1], "ctr", N_TESTS, N_SAMPLES,
                            "per_group", SEED)


@register("aa_simulation_pooled", _aa_sql("pooled"), doubles=_W)
def q_aa_simulation_pooled(spark, d):
    return ex.aa_simulation(spark, _users(spark, d, AA), AA[0], AA[1], "ctr", N_TESTS, N_SAMPLES,
                            "pooled", SEED)


@register("aa_summary", f"""
WITH st AS ({_aa_sql("pooled")}),
p AS (SELECT 2 * {_t_sf_sql("abs(t)", "df")} AS p FROM st)
SELECT CAST(least(floor(p * 20), 19) AS INTEGER) AS bin, least(floor(p * 20), 19) / 20 AS lo,
       (least(floor(p * 20), 19) + 1) / 20 AS hi, count(*) AS n,
       (SELECT 100 * avg(CAST(p <= 0.05 AS DOUBLE)) FROM p) AS share_le_alpha_pct
FROM p GROUP BY ALL""", doubles=("lo", "hi", "share_le_alpha_pct"))
def q_aa_summary(spark, d):
    """p-value histogram and share ≤ 0.05."""
    sims = ex.aa_simulation(spark, _users(spark, d, AA), AA[0], AA[1], "ctr", N_TESTS, N_SAMPLES,
                            "pooled", SEED)
    return ex.aa_summary(sims)


def _report_sql() -> str:
    c, t = AB
    long = f"""
SELECT 'ctr' AS metric, exp_group, ctr AS x FROM ({_users_sql(AB)})
UNION ALL SELECT 'posts', exp_group, posts FROM ({_users_sql(AB)})
UNION ALL SELECT 'smoothed_ctr', exp_group, smoothed_ctr FROM ({_smoothed_sql(AB)})
UNION ALL SELECT 'linearized_likes', exp_group, linearized_likes FROM ({_linearized_sql(c, AB)})
UNION ALL SELECT 'bucket_ctr', exp_group, bucket_ctr FROM ({_buckets_sql(AB)})
UNION ALL SELECT 'bootstrap_replicate_ctr', {c}, ctr_control FROM boot
UNION ALL SELECT 'bootstrap_replicate_ctr', {t}, ctr_test FROM boot"""
    metrics = ("ctr", "posts", "smoothed_ctr", "linearized_likes", "bucket_ctr", "bootstrap_replicate_ctr")
    one = lambda m: f"SELECT exp_group, x FROM long WHERE metric = '{m}'"
    welch = " UNION ALL ".join(f"SELECT '{m}' AS metric, t, df FROM ({_welch_sql(one(m), 'x', t, c)})" for m in metrics)
    mann = " UNION ALL ".join(f"SELECT '{m}' AS metric, u_a, z_greater, z_less, z_two_sided FROM ({_mw_sql(one(m), 'x', t, c)})"
                              for m in metrics)
    return f"""
WITH boot AS MATERIALIZED ({_bootstrap_sql()}),
long AS MATERIALIZED ({long}),
w AS ({welch}),
u AS ({mann})
SELECT metric, 'welch_t' AS method, t AS statistic, 2 * {_t_sf_sql("abs(t)", "df")} AS p_two_sided,
       {_t_sf_sql("t", "df")} AS p_greater, {_t_sf_sql("(-t)", "df")} AS p_less FROM w
UNION ALL
SELECT metric, 'mann_whitney', u_a, least(1.0, 2 * {_norm_sf_sql("z_two_sided")}),
       {_norm_sf_sql("z_greater")}, {_norm_sf_sql("z_less")} FROM u
UNION ALL
SELECT 'global_ctr', 'poisson_bootstrap', avg(ctr_test) - avg(ctr_control), NULL,
       1 - avg(CAST(diff > 0 AS DOUBLE)), avg(CAST(diff > 0 AS DOUBLE)) FROM boot"""


_P_VALUES = ("p_two_sided", "p_greater", "p_less")


@register("experiment_report", _report_sql(), doubles=("statistic", *_P_VALUES))
def q_experiment_report(spark, d):
    """Every method of the A/B analysis with p-values."""
    f, _ = load_events(spark, d)
    return ex.experiment_report(f, START, END, AB[0], AB[1], 5.0, 50, N_BOOT, SEED)


@register("welch_ttest_pvalues", f"""
WITH w AS ({_welch_sql(_users_sql(AB), "ctr", AB[1], AB[0])})
SELECT group_a, group_b, t, df, 2 * {_t_sf_sql("abs(t)", "df")} AS p_two_sided,
       {_t_sf_sql("t", "df")} AS p_greater, {_t_sf_sql("(-t)", "df")} AS p_less, 1 AS tests
FROM w""", doubles=("t", "df", *_P_VALUES))
def q_welch_ttest_pvalues(spark, d):
    """Welch test with p-values for the three alternatives."""
    return ex.welch_ttest(_users(spark, d, AB), "ctr", "exp_group", AB[1], AB[0]).select(
        "group_a", "group_b", "t", "df", "p_two_sided", "p_greater", "p_less",
        F.lit(1).alias("tests"))
