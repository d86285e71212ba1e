"""A/B and A/A experiment statistics.

Per-user metrics come from one aggregation keyed by (exp_group, user).
Tests reduce each sample to sufficient statistics with ordinary aggregations
(count / mean / variance for Welch, distinct-value counts and a distributed
prefix sum for Mann–Whitney).  Resampling (Poisson bootstrap, A/A simulation)
generates draws next to the data with a deterministic hash and aggregates
them with map-side partial sums, so only (replicate, group) partials are
shuffled — never a users × replicates matrix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.functions.hashing import (count_not_above, draw, draw_index, draw_state, md5_bucket, poisson_table,
                                        poisson_weight)
from cohortia.functions.metrics import ratio, scalars
from cohortia.functions.ranks import dense_index, prefix_sum
from cohortia.functions.stats import exact_u_sf, norm_sf_col, t_pvalue_col, welch_columns
from cohortia.functions.timefn import date_lit, day
from cohortia.session import materialize


# ---------------------------------------------------------------- per-user metrics

def experiment_user_metrics(feed: DataFrame, start, end, groups: tuple[int, ...]) -> DataFrame:
    """(exp_group, user_id, likes, views, ctr, posts) over [start, end].

    ctr is NULL for users without views (quirk D16: they are excluded from tests).
    """
    f = feed.where(day().between(date_lit(start), date_lit(end))
                   & F.col("exp_group").isin(*groups))
    likes = F.count_if(F.col("action") == "like")
    views = F.count_if(F.col("action") == "view")
    return (f.groupBy("exp_group", "user_id")
            .agg(likes.alias("likes"), views.alias("views"),
                 F.countDistinct("post_id").alias("posts"))
            .select("exp_group", "user_id", "likes", "views", ratio("likes", "views").alias("ctr"),
                    "posts"))


def group_ctr(users: DataFrame) -> DataFrame:
    """Global CTR per group: Σlikes / Σviews (one row per group)."""
    return users.groupBy("exp_group").agg(
        ratio(F.sum("likes"), F.sum("views")).alias("group_ctr"))


def smoothed_ctr(users: DataFrame, alpha: float = 5.0) -> DataFrame:
    """(likes + α·CTR_group) / (views + α), CTR_group of the user's own group.

    The per-group table has one row per experiment group, so the join is a
    broadcast of a handful of rows.
    """
    users = materialize(users)                    # read by the group CTRs and by the join
    g = F.broadcast(group_ctr(users))
    return users.join(g, "exp_group").withColumn(
        "smoothed_ctr",
        (F.col("likes") + F.lit(alpha) * F.col("group_ctr")) / (F.col("views") + F.lit(alpha))
    ).drop("group_ctr")


def linearized_likes(users: DataFrame, control: int) -> DataFrame:
    """Likes − CTR_control · views (CTR_control = Σlikes/Σviews of the control)."""
    users = materialize(users)                    # read by the scalar and by the projection
    ctrl = users.where(F.col("exp_group") == control).select(
        ratio(F.sum("likes"), F.sum("views"))).scalar()
    return users.withColumn("linearized_likes", F.col("likes") - ctrl * F.col("views"))


def bucket_ctr(feed: DataFrame, start, end, groups: tuple[int, ...], n_buckets: int = 50,
               bucket_fn=md5_bucket) -> DataFrame:
    """(exp_group, bucket, users, likes, views, bucket_ctr = Σlikes/Σviews)."""
    return bucket_ctr_from_users(experiment_user_metrics(feed, start, end, groups), n_buckets, bucket_fn)


def bucket_ctr_from_users(u: DataFrame, n_buckets: int = 50, bucket_fn=md5_bucket) -> DataFrame:
    """C26 from an existing per-user table."""
    return (u.groupBy("exp_group", bucket_fn("user_id", n_buckets).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("users"), F.sum("likes").alias("likes"),
                 F.sum("views").alias("views"))
            .withColumn("bucket_ctr", ratio("likes", "views")))


# ---------------------------------------------------------------- Welch t-test

def welch_stats(df: DataFrame, value: str, group_col: str, a, b,
                keys: tuple[str, ...] = ()) -> DataFrame:
    """T1/T2 statistics in one aggregation per key: n, mean, var per sample, t, df.

    Sample ``a`` is the first argument of ``ttest_ind`` (t > 0 ⇔ mean_a > mean_b).
    ``keys`` runs many tests at once (one row per key).  Rows without a value take no part
    and are counted in ``n_dropped_a`` and ``n_dropped_b``.
    """
    v = F.col(value)
    ga, gb = F.col(group_col) == F.lit(a), F.col(group_col) == F.lit(b)
    s = df.groupBy(*keys).agg(
        F.count_if(ga & v.isNull()).alias("n_dropped_a"), F.count_if(gb & v.isNull()).alias("n_dropped_b"),
        F.count(F.when(ga, v)).alias("n_a"), F.count(F.when(gb, v)).alias("n_b"),
        F.avg(F.when(ga, v)).alias("mean_a"), F.avg(F.when(gb, v)).alias("mean_b"),
        F.var_samp(F.when(ga, v)).alias("var_a"), F.var_samp(F.when(gb, v)).alias("var_b"))
    t, dof = welch_columns(F.col("n_a"), F.col("mean_a"), F.col("var_a"),
                           F.col("n_b"), F.col("mean_b"), F.col("var_b"))
    return s.select(*keys, F.lit(str(a)).alias("group_a"), F.lit(str(b)).alias("group_b"),
                    "n_a", "n_b", "n_dropped_a", "n_dropped_b", "mean_a", "mean_b", "var_a", "var_b", t.alias("t"), dof.alias("df"))


def with_t_pvalues(stats: DataFrame, t: str = "t", dof: str = "df") -> DataFrame:
    return stats.select("*", *[t_pvalue_col(F.col(t), F.col(dof), alt).alias(f"p_{alt.replace('-', '_')}")
                               for alt in ("two-sided", "greater", "less")])


def welch_ttest(df: DataFrame, value: str, group_col: str, a, b) -> DataFrame:
    """Welch t-test with two-sided / greater / less p-values."""
    return with_t_pvalues(welch_stats(df, value, group_col, a, b))


# ---------------------------------------------------------------- Mann–Whitney U

def _u_statistics(df: DataFrame, value: str, group_col: str, a, b, keys: tuple[str, ...]) -> DataFrame:
    """(keys…, n_a, n_b, u_a, tie_term, n_dropped_a, n_dropped_b): one row per key with a value."""
    v = F.col(value)
    ga, gb = F.col(group_col) == F.lit(a), F.col(group_col) == F.lit(b)
    cnt = materialize(df.where(ga | gb).groupBy(*keys, value).agg(F.count_if(ga).alias("n1"), F.count_if(gb).alias("n2")))
    cum = prefix_sum(cnt.where(v.isNotNull()), value, "n2", keys, out="c2")
    s = cum.groupBy(*keys).agg(
        F.sum("n1").alias("n_a"), F.sum("n2").alias("n_b"),
        F.sum(F.col("n1") * (F.col("c2") + F.col("n2") / 2.0)).alias("u_a"),
        F.sum(F.pow((F.col("n1") + F.col("n2")).cast("double"), 3)
              - (F.col("n1") + F.col("n2"))).alias("tie_term"))
    # rows without a value are one row per key of the counts
    none = cnt.where(v.isNull())
    if not keys:
        d = scalars(none, a=F.coalesce(F.sum("n1"), F.lit(0)), b=F.coalesce(F.sum("n2"), F.lit(0)))
        return s.select("*", d["a"].alias("n_dropped_a"), d["b"].alias("n_dropped_b"))
    none = none.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("n1").alias("_n1"), F.col("n2").alias("_n2"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return s.join(none, same, "left").select(
        *s.columns, F.coalesce("_n1", F.lit(0)).alias("n_dropped_a"), F.coalesce("_n2", F.lit(0)).alias("n_dropped_b"))


def mann_whitney_stats(df: DataFrame, value: str, group_col: str, a, b,
                       keys: tuple[str, ...] = (), details: bool = False) -> DataFrame:
    """T3 statistics: U_a = Σ_v n_a(v)·(n_b(<v) + n_b(v)/2), tie-corrected σ, z values.

    Distinct values and their per-sample counts come from one partial
    aggregation (written once: every pass below reads it); n_b(<v) is a
    distributed prefix sum.  z uses SciPy's asymptotic form with continuity
    correction: for 'greater' U = U_a, for 'less' U = U_b, for 'two-sided'
    U = max(U_a, U_b).  ``keys`` runs many tests at once (one row per key).  ``details`` adds
    ``tied`` (does a value occur twice?) and the numbers of rows without a value, which take no part.
    """
    keys = tuple(keys)
    s = _u_statistics(df, value, group_col, a, b, keys)
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n_a + n_b
    mu = n_a * n_b / 2.0
    sigma = F.sqrt(n_a * n_b / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    u_b = n_a * n_b - F.col("u_a")
    more = [(F.col("tie_term") > 0).alias("tied"), "n_dropped_a", "n_dropped_b"] if details else []
    s = s.select(*keys, F.lit(str(a)).alias("group_a"), F.lit(str(b)).alias("group_b"),
                 "n_a", "n_b", "u_a", u_b.alias("u_b"), mu.alias("mu"), sigma.alias("sigma"), *more)
    z = lambda u: F.try_divide(u - F.col("mu") - 0.5, F.col("sigma"))
    return s.select("*", z(F.col("u_a")).alias("z_greater"), z(F.col("u_b")).alias("z_less"),
                    z(F.greatest("u_a", "u_b")).alias("z_two_sided"))


def with_exact_u_pvalues(stats: DataFrame, exact_max: int = 8) -> DataFrame:
    """Add exact_greater / exact_less / exact_two_sided to detailed U statistics: the share of
    all orders of both samples with such a U.  Null with ties, an empty sample, or more than ``exact_max`` values in either."""
    usable = ~F.col("tied") & (F.least("n_a", "n_b") > 0) & (F.greatest("n_a", "n_b") <= exact_max)
    up = exact_u_sf(F.col("n_a"), F.col("n_b"), F.col("u_a"))
    down = exact_u_sf(F.col("n_a"), F.col("n_b"), F.col("u_b"))
    s = stats.select("*", F.when(usable, up).alias("exact_greater"), F.when(usable, down).alias("exact_less"))
    return s.select("*", F.least(F.lit(1.0), 2 * F.least("exact_greater", "exact_less")).alias("exact_two_sided")) \
        .withColumn("exact_two_sided", F.when(F.col("exact_greater").isNotNull(), F.col("exact_two_sided")))


def mann_whitney(df: DataFrame, value: str, group_col: str, a, b, keys: tuple[str, ...] = (),
                 exact_max: int = 8) -> DataFrame:
    """U test with p-values: exact for samples without ties of at most ``exact_max`` values
    each, the normal approximation beyond; ``exact`` tells which, ``n_dropped_*`` what took no part."""
    s = with_exact_u_pvalues(mann_whitney_stats(df, value, group_col, a, b, keys, details=True), exact_max)
    p = lambda name, tail: F.coalesce(f"exact_{name}", tail).alias(f"p_{name}")
    return s.select("*", F.col("exact_greater").isNotNull().alias("exact"),
                    p("greater", norm_sf_col(F.col("z_greater"))), p("less", norm_sf_col(F.col("z_less"))),
                    p("two_sided", F.least(F.lit(1.0), 2 * norm_sf_col(F.col("z_two_sided"))))) \
        .drop("exact_greater", "exact_less", "exact_two_sided")


# ---------------------------------------------------------------- resampling

def poisson_bootstrap(users: DataFrame, control: int, test: int, n_bootstrap: int = 2000,
                      seed: int = 0) -> DataFrame:
    """T5: (replicate, ctr_control, ctr_test, diff = ctr_test − ctr_control).

    Every user gets a Poisson(1) weight per replicate (inverse CDF of a 62-bit draw).
    The user's keys are hashed once, before the replicates.  Replicates are generated next to each user with
    ``explode(sequence)`` and summed by (replicate, group) with partial
    aggregation, so the shuffle carries ≤ 2·n_bootstrap rows per map task.
    """
    u = users.where(F.col("exp_group").isin(control, test)).select(
        "exp_group", "likes", "views", draw_state(seed, F.col("exp_group"), F.col("user_id")).alias("state"))
    r = u.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_bootstrap))).alias("replicate"))
    r = r.select("exp_group", "replicate", "likes", "views", draw(F.col("state"), F.col("replicate")).alias("x"))
    r = r.select("exp_group", "replicate", "likes", "views", poisson_weight(F.col("x")).alias("w"))
    return _replicate_ctr(r, control, test)


def _replicate_ctr(r: DataFrame, control: int, test: int) -> DataFrame:
    """CTR of both groups by replicate from weighted rows (replicate, exp_group, likes, views, w)."""
    g = (r.groupBy("replicate")
         .agg(F.sum(F.when(F.col("exp_group") == control, F.col("w") * F.col("likes"))).alias("lc"),
              F.sum(F.when(F.col("exp_group") == control, F.col("w") * F.col("views"))).alias("vc"),
              F.sum(F.when(F.col("exp_group") == test, F.col("w") * F.col("likes"))).alias("lt"),
              F.sum(F.when(F.col("exp_group") == test, F.col("w") * F.col("views"))).alias("vt")))
    return g.select("replicate", ratio("lc", "vc").alias("ctr_control"),
                    ratio("lt", "vt").alias("ctr_test"),
                    (ratio("lt", "vt") - ratio("lc", "vc")).alias("diff"))


PIECE_BITS = 12     # a cell's users are drawn in pieces of 1, 2, 4 … 4,096 users


def bootstrap_pieces(users: DataFrame, control: int, test: int) -> DataFrame:
    """(exp_group, likes, views, bits, copy): each cell of users with equal counts, split into
    pieces of 2^bits users: the bits of its size, and as many pieces of 4,096 as it holds."""
    cells = (users.where(F.col("exp_group").isin(control, test)).groupBy("exp_group", "likes", "views")
             .agg(F.count(F.lit(1)).alias("n")))
    large = F.shiftright("n", PIECE_BITS)
    piece = lambda bits, copy: F.struct(bits.cast("int").alias("bits"), copy.cast("long").alias("copy"))
    small = F.filter(F.transform(F.sequence(F.lit(0), F.lit(PIECE_BITS - 1)), lambda b: piece(b, F.lit(0))),
                     lambda x: F.getbit("n", x["bits"]) == 1)
    big = F.when(large > 0, F.transform(F.sequence(F.lit(1).cast("long"), large), lambda c: piece(F.lit(PIECE_BITS), c)))
    pieces = cells.select("exp_group", "likes", "views", F.explode(F.concat(small, F.coalesce(big, F.filter(small, lambda x: F.lit(False))))).alias("p"))
    return pieces.select("exp_group", "likes", "views", "p.bits", "p.copy")


def poisson_bootstrap_cells(users: DataFrame, control: int, test: int, n_bootstrap: int = 2000,
                            seed: int = 0) -> DataFrame:
    """T5 as ``poisson_bootstrap``, whose rows follow distinct cells instead of users.

    n users with equal likes and views weigh Poisson(n) together, since weights of single users
    are Poisson(1).  Poisson(n) is the sum of a draw for every bit of n (one for each 4,096
    users above), each by inverse CDF of a 62-bit draw without a cap, found by bisection.  Rows:
    replicates × pieces, at most 12 + n / 4,096 for a cell.  Pieces are spread over tasks before
    replicates are made, so a cell with a third of all users is not one task's.
    """
    spark = users.sparkSession
    rows = []
    for bits in range(PIECE_BITS + 1):
        low, thresholds = poisson_table(2 ** bits)
        rows.append((bits, low, thresholds, [2 ** i for i in reversed(range(len(thresholds).bit_length()))]))
    tables = spark.createDataFrame(rows, "bits int, low int, thresholds array<bigint>, steps array<int>")   # 13 rows
    p = bootstrap_pieces(users, control, test).repartition("exp_group", "likes", "views", "bits", "copy")
    p = p.select("exp_group", "likes", "views", "bits",
                 draw_state(seed, F.col("exp_group"), F.col("likes"), F.col("views"), F.col("bits"), F.col("copy")).alias("state"))
    r = p.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_bootstrap))).alias("replicate"))
    r = r.select("exp_group", "likes", "views", "replicate", "bits", draw(F.col("state"), F.col("replicate")).alias("x"))
    r = r.join(F.broadcast(tables), "bits")
    r = r.withColumn("w", F.col("low") + count_not_above(F.col("thresholds"), F.col("x"), F.col("steps")))
    return _replicate_ctr(r, control, test)


def bootstrap_summary(boot: DataFrame, level: float = 0.95) -> DataFrame:
    """Mean / median per arm, percentile interval of diff and share of diff > 0.

    Quantiles run over n_bootstrap rows (bounded by the parameter)."""
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    return boot.agg(F.avg("ctr_control").alias("mean_control"), F.avg("ctr_test").alias("mean_test"),
                    F.median("ctr_control").alias("median_control"),
                    F.median("ctr_test").alias("median_test"),
                    F.percentile("diff", lo).alias("diff_lo"), F.percentile("diff", hi).alias("diff_hi"),
                    F.avg((F.col("diff") > 0).cast("double")).alias("share_diff_positive"),
                    F.count(F.lit(1)).alias("n_bootstrap"))


def aa_simulation(spark: SparkSession, users: DataFrame, a: int, b: int, value: str = "ctr",
                  n_tests: int = 10000, n_samples: int = 500, null: str = "per_group",
                  seed: int = 0) -> DataFrame:
    """T4: per simulated test, Welch statistics of two samples drawn with replacement.

    ``null='per_group'`` draws sample a from group a and b from group b (as
    written); ``'pooled'`` draws both from the union (a true A/A null).
    Users get a dense index per pool (distributed, ordered by user_id); each
    draw (sim, sample, k) picks an index from a 62-bit draw and is matched to its
    user by an equi-join on the index, hashed on the pool's side.  The simulated
    draws are aggregated by (sim, sample) with partial sums.
    """
    pool = materialize(users.where(F.col("exp_group").isin(a, b) & F.col(value).isNotNull()).select("exp_group", "user_id", value))
    draws = (spark.range(n_tests).withColumnRenamed("id", "sim")
             .select("sim", F.explode(F.array(F.lit(0), F.lit(1))).alias("sample"))
             .select("sim", "sample", draw_state(seed, F.col("sim"), F.col("sample")).alias("state"))
             .select("sim", "sample", "state", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("k"))
             .select("sim", "sample", draw(F.col("state"), F.col("k")).alias("x")))
    if null == "pooled":
        # one pool: index all users of both groups together
        pool = materialize(dense_index(pool.select("user_id", F.col(value).alias("x")), "user_id"))
        size = pool.select(F.count(F.lit(1))).scalar()
        draws = draws.select("sim", "sample", draw_index(F.col("x"), size).alias("idx"))
        picked = draws.join(pool.select("idx", "x").hint("shuffle_hash"), "idx")
    elif null == "per_group":
        pool = pool.select(F.when(F.col("exp_group") == a, 0).otherwise(1).alias("sample"),
                           "user_id", F.col(value).alias("x"))
        pool = materialize(dense_index(pool, "user_id", ("sample",)))
        sizes = pool.groupBy("sample").agg(F.count(F.lit(1)).alias("size"))
        # sizes has one row per sample (two rows): a broadcast of proven size
        draws = draws.join(F.broadcast(sizes), "sample").select(
            "sim", "sample", draw_index(F.col("x"), F.col("size")).alias("idx"))
        picked = draws.join(pool.select("sample", "idx", "x").hint("shuffle_hash"), ["sample", "idx"])
    else:
        raise ValueError(null)
    st = (picked.groupBy("sim")
          .agg(F.count(F.when(F.col("sample") == 0, F.col("x"))).alias("n_a"),
               F.count(F.when(F.col("sample") == 1, F.col("x"))).alias("n_b"),
               F.avg(F.when(F.col("sample") == 0, F.col("x"))).alias("mean_a"),
               F.avg(F.when(F.col("sample") == 1, F.col("x"))).alias("mean_b"),
               F.var_samp(F.when(F.col("sample") == 0, F.col("x"))).alias("var_a"),
               F.var_samp(F.when(F.col("sample") == 1, F.col("x"))).alias("var_b")))
    t, dof = welch_columns(F.col("n_a"), F.col("mean_a"), F.col("var_a"),
                           F.col("n_b"), F.col("mean_b"), F.col("var_b"))
    return st.select("*", t.alias("t"), dof.alias("df"))


def aa_summary(sims: DataFrame, alpha: float = 0.05, bins: int = 20) -> DataFrame:
    """Share (%) of p ≤ alpha and the p-value histogram (``bins`` equal bins on [0, 1]).

    Returns one row per bin: bin, lo, hi, n, plus the overall share on every row.
    """
    # one row per simulation: written once, read by the histogram and by the share
    p = materialize(with_t_pvalues(sims).select(F.col("p_two_sided").alias("p")))
    hist = p.groupBy(F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    share = p.select(100 * F.avg((F.col("p") <= alpha).cast("double"))).scalar()
    return hist.select("bin", (F.col("bin") / bins).alias("lo"), ((F.col("bin") + 1) / bins).alias("hi"),
                       "n", share.alias("share_le_alpha_pct"))


# ---------------------------------------------------------------- method table

def experiment_report(feed: DataFrame, start, end, control: int, test: int,
                      alpha_smooth: float = 5.0, n_buckets: int = 50,
                      n_bootstrap: int = 2000, seed: int = 0) -> DataFrame:
    """Every method of the reference on one experiment, as rows
    (metric, method, statistic, p_two_sided, p_greater, p_less).

    Sample a is the test group, b the control (t > 0 ⇔ test higher).
    """
    # one row per user, read by every method below: materialize it once in the
    # session's reliable checkpoint directory (cuts lineage, survives executor loss)
    users = materialize(experiment_user_metrics(feed, start, end, (control, test)))
    sm = smoothed_ctr(users, alpha_smooth)
    lin = linearized_likes(users, control)
    buckets = bucket_ctr_from_users(users, n_buckets)

    # every metric of every method melted into one (metric, exp_group, x) frame: one keyed
    # Welch aggregation and one keyed Mann–Whitney pass test them all; tails once at the end
    replicates = materialize(poisson_bootstrap(users, control, test, n_bootstrap, seed))
    boot = bootstrap_summary(replicates)
    # quirk D19 (compat rows): the reference also ran t and U tests on the replicate CTRs
    # as if they were observations, so those p-values depend on n_bootstrap
    rep_long = replicates.select(F.explode(F.array(
        F.struct(F.lit(control).alias("exp_group"), F.col("ctr_control").alias("x")),
        F.struct(F.lit(test).alias("exp_group"), F.col("ctr_test").alias("x")))).alias("r")
    ).select(F.lit("bootstrap_replicate_ctr").alias("metric"), "r.*")

    def part(df: DataFrame, col: str, metric: str) -> DataFrame:
        return df.select(F.lit(metric).alias("metric"), "exp_group", F.col(col).cast("double").alias("x"))

    long = (part(users, "ctr", "ctr").unionByName(part(sm, "smoothed_ctr", "smoothed_ctr"))
            .unionByName(part(lin, "linearized_likes", "linearized_likes"))
            .unionByName(part(buckets, "bucket_ctr", "bucket_ctr"))
            .unionByName(part(users, "posts", "posts")).unionByName(rep_long))
    w = welch_stats(long, "x", "exp_group", test, control, ("metric",)).select(
        "metric", F.lit("welch_t").alias("method"), F.col("t").alias("statistic"), "t", "df",
        *[F.lit(None).cast("double").alias(z) for z in ("z_greater", "z_less", "z_two_sided")])
    u = mann_whitney_stats(long, "x", "exp_group", test, control, ("metric",)).select(
        "metric", F.lit("mann_whitney").alias("method"), F.col("u_a").alias("statistic"),
        F.lit(None).cast("double").alias("t"), F.lit(None).cast("double").alias("df"),
        "z_greater", "z_less", "z_two_sided")
    stats = w.unionByName(u)
    stats = materialize(stats)                     # a dozen rows; tails computed once below
    is_t = F.col("method") == "welch_t"
    tails = stats.select(
        "metric", "method", "statistic",
        F.when(is_t, t_pvalue_col(F.col("t"), F.col("df"), "two-sided"))
         .otherwise(F.least(F.lit(1.0), 2 * norm_sf_col(F.col("z_two_sided")))).alias("p_two_sided"),
        F.when(is_t, t_pvalue_col(F.col("t"), F.col("df"), "greater"))
         .otherwise(norm_sf_col(F.col("z_greater"))).alias("p_greater"),
        F.when(is_t, t_pvalue_col(F.col("t"), F.col("df"), "less"))
         .otherwise(norm_sf_col(F.col("z_less"))).alias("p_less"))
    boot_row = boot.select(F.lit("global_ctr").alias("metric"), F.lit("poisson_bootstrap").alias("method"),
                           (F.col("mean_test") - F.col("mean_control")).alias("statistic"),
                           F.lit(None).cast("double").alias("p_two_sided"),
                           (1 - F.col("share_diff_positive")).alias("p_greater"),
                           F.col("share_diff_positive").alias("p_less"))
    return tails.unionByName(boot_row)
