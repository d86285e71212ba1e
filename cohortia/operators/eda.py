"""Exploratory statistics.

Everything reduces the data with aggregations first; chart data (histograms,
KDE curves, pair bins, QQ points) is computed from binned or quantile
summaries whose size is set by a parameter, not by the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cohortia.functions.metrics import ratio, scalars
from cohortia.functions.ranks import exact_quantiles
from cohortia.functions.timefn import day, hour_start, seconds_between
from cohortia.session import materialize


# ---------------------------------------------------------------- post and daily tables

def posts_views_likes(feed: DataFrame) -> DataFrame:
    """(post_id, likes, views)."""
    return feed.groupBy("post_id").agg(F.count_if(F.col("action") == "like").alias("likes"),
                                       F.count_if(F.col("action") == "view").alias("views"))


def post_stats(feed: DataFrame) -> DataFrame:
    """(post_id, likes, views, ctr, start_date, end_date, lifetime_sec)."""
    p = feed.groupBy("post_id").agg(F.min("time").alias("start_date"), F.max("time").alias("end_date"),
                                    F.count_if(F.col("action") == "like").alias("likes"),
                                    F.count_if(F.col("action") == "view").alias("views"))
    return p.select("post_id", "likes", "views", ratio("likes", "views").alias("ctr"),
                    "start_date", "end_date",
                    seconds_between("start_date", "end_date").alias("lifetime_sec"))


def lifetime_summary(posts: DataFrame) -> DataFrame:
    """T13 (quirk D10): mean post lifetime in seconds, hours and days."""
    m = F.avg("lifetime_sec")
    return posts.agg(m.alias("mean_lifetime_sec"), (m / 3600).alias("mean_lifetime_hours"),
                     (m / 86400).alias("mean_lifetime_days"))


def daily_views_likes(feed: DataFrame) -> DataFrame:
    """(day, views, likes) — sums of the user-day table per day."""
    return feed.groupBy(day().alias("day")).agg(F.count_if(F.col("action") == "view").alias("views"),
                                                F.count_if(F.col("action") == "like").alias("likes"))


def central_tendency(daily: DataFrame, cols=("views", "likes")) -> DataFrame:
    """Mean and median of each column (exact median; the input has one row per day)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.median(c).alias(f"{c}_median")]
    return daily.agg(*aggs)


def daily_users(feed: DataFrame) -> DataFrame:
    """(day, num_of_users)."""
    return feed.groupBy(day().alias("day")).agg(F.countDistinct("user_id").alias("num_of_users"))


def daily_unique_posts(feed: DataFrame) -> DataFrame:
    """(day, posts) — distinct posts seen per day."""
    return feed.groupBy(day().alias("day")).agg(F.countDistinct("post_id").alias("posts"))


def hourly_activity(feed: DataFrame) -> DataFrame:
    """(day_h, actions) — actions per hour."""
    return feed.groupBy(hour_start().alias("day_h")).agg(F.count("user_id").alias("actions"))


def hour_profile(feed: DataFrame) -> DataFrame:
    """(day, hour, actions)."""
    return feed.groupBy(day().alias("day"), F.hour("time").alias("hour")).agg(
        F.count("user_id").alias("actions"))


def publication_hour_profile(feed: DataFrame) -> DataFrame:
    """Posts per hour of day of their first activity (proxy of publication)."""
    first = feed.groupBy("post_id").agg(F.min(hour_start()).alias("publication_time"))
    return first.groupBy(F.hour("publication_time").alias("hour")).agg(
        F.countDistinct("post_id").alias("posts"))


# ---------------------------------------------------------------- moments and shape

def describe_by_group(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pandas ``describe()`` per group — count, mean, std, min, 25%, 50%, 75%, max.

    Quartiles are exact (linear interpolation) from distributed ranks.
    """
    keys = tuple(keys)
    df = materialize(df.select(*keys, value))                        # moments + quantile passes
    base = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"), F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"))
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], keys)
    qw = q.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    if not keys:  # one global row: the quartiles are read as one scalar subquery
        sq = scalars(qw, q25=F.first("q25"), q50=F.first("q50"), q75=F.first("q75"))
        out = base.select("*", *[sq[n].alias(n) for n in ("q25", "q50", "q75")])
    else:
        out = base.join(qw, list(keys))
    return out.select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def skewness(df: DataFrame, cols: list[str]) -> DataFrame:
    """SciPy's (biased, population) skewness of each column: rows (column, skewness)."""
    row = df.agg(*[F.skewness(c).alias(c) for c in cols])
    return row.unpivot([], cols, "column", "skewness")


def zscore(df: DataFrame, cols: list[str], suffix: str = "_z") -> DataFrame:
    """(x − mean) / std (sample std) as new columns; the moments are one global
    aggregation referenced as scalar subqueries (no unpartitioned window)."""
    df = materialize(df)                                             # moments pass + scaling pass
    mom = scalars(df, **{f"m_{c}": F.avg(c) for c in cols}, **{f"s_{c}": F.stddev_samp(c) for c in cols})
    return df.select("*", *[F.try_divide(F.col(c) - mom[f"m_{c}"], mom[f"s_{c}"]).alias(c + suffix)
                            for c in cols])


# ---------------------------------------------------------------- chart data

def histogram(df: DataFrame, value: str, bins: int = 20, keys: tuple[str, ...] = ()) -> DataFrame:
    """Equal-width bins over [min, max] of ``value`` (common to all groups, last bin
    closed like numpy) → (keys…, bin, lo, hi, n)."""
    keys = tuple(keys)
    v = F.col(value).cast("double")
    d = materialize(df.select(*keys, value).where(v.isNotNull()))   # range pass + bin pass
    r = scalars(d, lo=F.min(v), hi=F.max(v))
    lo, hi = r["lo"], r["hi"]
    width = (hi - lo) / bins
    b = F.least(F.coalesce(F.floor(F.try_divide(v - lo, hi - lo) * bins), F.lit(0)),
                F.lit(bins - 1)).cast("int")
    h = d.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select(*keys, "bin", (lo + F.col("bin") * width).alias("lo"),
                    (lo + (F.col("bin") + 1) * width).alias("hi"), "n")


def kde_curve(df: DataFrame, value: str, grid: int = 200, fine_bins: int = 1024,
              cut: float = 3.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth h = std·n^(−1/5)) evaluated on ``grid`` points
    over [min − cut·h, max + cut·h], computed from ``fine_bins`` binned counts.

    Work is fine_bins × grid regardless of the data size: each non-empty bin
    explodes to the grid points and one aggregation sums the kernels.
    """
    v = F.col(value).cast("double")
    d = materialize(df.select(value).where(v.isNotNull()))          # moments pass + bin pass
    st = scalars(d, n=F.count(F.lit(1)).cast("double"), lo=F.min(v), hi=F.max(v),
                 h=F.stddev_samp(v) * F.pow(F.count(F.lit(1)).cast("double"), -0.2))
    n, lo, hi, h = st["n"], st["lo"], st["hi"], st["h"]
    width = (F.col("hi") - F.col("lo")) / fine_bins
    b = F.least(F.coalesce(F.floor(F.try_divide(v - lo, hi - lo) * fine_bins), F.lit(0)),
                F.lit(fine_bins - 1)).cast("int")
    binned = (d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
              .select("bin", "c", n.alias("n"), lo.alias("lo"), hi.alias("hi"), h.alias("h")))
    centre = F.col("lo") + (F.col("bin") + 0.5) * width
    g0 = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)
    pts = binned.select("c", "n", "h", centre.alias("centre"), g0.alias("g0"), step.alias("step"),
                        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    x = F.col("g0") + F.col("i") * F.col("step")
    z = (x - F.col("centre")) / F.col("h")
    k = F.col("c") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return pts.groupBy(F.col("i").cast("long").alias("i")).agg(F.first(x).alias("x"), F.sum(k).alias("density")) \
        .select("i", "x", "density")


def pair_bins(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """2-D binned counts for every pair of ``cols`` → (x_col, y_col, x_bin, y_bin, n).

    Each row is melted into one row per column pair (fixed count) and binned
    on per-column [min, max]; one aggregation counts cells.
    """
    df = materialize(df.select(*cols))                               # range pass + bin pass
    r = scalars(df, **{f"lo_{c}": F.min(F.col(c).cast("double")) for c in cols},
                **{f"hi_{c}": F.max(F.col(c).cast("double")) for c in cols})
    rng = {c: (r[f"lo_{c}"], r[f"hi_{c}"]) for c in cols}

    def bin_of(c):
        lo, hi = rng[c]
        v = F.col(c).cast("double")
        return F.least(F.coalesce(F.floor(F.try_divide(v - lo, hi - lo) * bins), F.lit(0)),
                       F.lit(bins - 1)).cast("int")

    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    melted = F.explode(F.array(*[
        F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"), bin_of(a).alias("x_bin"),
                 bin_of(b).alias("y_bin")) for a, b in pairs]))
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return (df.where(cond).select(melted.alias("p")).select("p.*")
            .groupBy("x_col", "y_col", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n")))


def qq_points(df: DataFrame, x: str, y: str, n_points: int = 101, standardize: bool = True) -> DataFrame:
    """Two-sample QQ data — quantiles of (z-scored) x and y at ``n_points`` evenly
    spaced probabilities → (prob, x_q, y_q)."""
    d = zscore(df, [x, y]) if standardize else materialize(df.select(x, y))
    cx, cy = (x + "_z", y + "_z") if standardize else (x, y)
    probs = [i / (n_points - 1) for i in range(n_points)]
    long = d.select(F.explode(F.array(
        F.struct(F.lit("x").alias("s"), F.col(cx).cast("double").alias("v")),
        F.struct(F.lit("y").alias("s"), F.col(cy).cast("double").alias("v")))).alias("t")).select("t.*")
    q = exact_quantiles(long, "v", probs, ("s",))
    return q.groupBy("prob").agg(F.max(F.when(F.col("s") == "x", F.col("quantile"))).alias("x_q"),
                                 F.max(F.when(F.col("s") == "y", F.col("quantile"))).alias("y_q"))


# ---------------------------------------------------------------- seasonal decomposition

def seasonal_decompose(series: DataFrame, ts: str = "day_h", value: str = "actions",
                       keys: tuple[str, ...] = (), period: int = 24) -> DataFrame:
    """Additive decomposition of an hourly series (re-aimed STL).

    Hours without rows are filled with 0 (dense calendar per key); trend is the
    centred 2×period moving average (NULL where the window is incomplete);
    seasonal is the mean detrended value per hour of day, centred to zero;
    resid = observed − trend − seasonal.  Windows are partitioned by ``keys``
    (one series per key; its length is bounded by the calendar).
    """
    keys = tuple(keys)
    series = materialize(series.select(*keys, ts, value))   # one row per hour: span + densify
    span = series.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    cal = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(ts))
    dense = cal.join(series.select(*keys, ts, value), [*keys, ts], "left") \
        .select(*keys, ts, F.coalesce(F.col(value), F.lit(0)).cast("double").alias("observed"))
    w = Window.partitionBy(*keys).orderBy(ts)
    half = period // 2
    frame = w.rowsBetween(-half, half)
    full = F.count("observed").over(frame) == 2 * half + 1
    ma = (F.sum("observed").over(frame) - 0.5 * F.lag("observed", half).over(w)
          - 0.5 * F.lead("observed", half).over(w)) / period
    x = dense.select("*", F.when(full, ma).alias("trend"), F.hour(ts).alias("_hod"))
    idx = x.groupBy(*keys, "_hod").agg(F.avg(F.col("observed") - F.col("trend")).alias("_s"))
    idx = idx.select(*keys, "_hod", (F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys)))
                     .alias("seasonal"))
    out = x.join(idx, [*keys, "_hod"])
    return out.select(*keys, ts, "observed", "trend", "seasonal",
                      (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"))


def local_line(y: Column, weight: Column, x: Column, window: WindowSpec) -> Column:
    """Weighted least-squares line through the rows of ``window``, at the row's own ``x``.

    Five window sums, shifted to the row, give the line in closed form.  Where the weights leave
    fewer than two places it is the weighted mean, where they leave none the plain mean."""
    s0, s1, s2, b0, b1 = (F.sum(v).over(window) for v in (weight, weight * x, weight * x * x, weight * y, weight * x * y))
    a1, a2, c1 = s1 - x * s0, s2 - 2 * x * s1 + x * x * s0, b1 - x * b0
    det = s0 * a2 - a1 * a1
    return F.when(det > 1e-6 * s0 * s0, F.try_divide(a2 * b0 - a1 * c1, det)).otherwise(
        F.coalesce(F.try_divide(b0, s0), F.avg(y).over(window)))


def robust_decompose(series: DataFrame, ts: str = "day_h", value: str = "actions", keys: tuple[str, ...] = (),
                     period: int = 24, trend_span: int = 24, cycles: int = 7, inner: int = 2,
                     robust_rounds: int = 2) -> DataFrame:
    """T10, robust: (keys…, ts, observed, trend, seasonal, resid, weight) of hourly series.

    Hours without rows count as 0 (dense calendar per key).  ``inner`` times in turn, the trend is
    the local line of what the season leaves, ``trend_span`` hours either way, and the season the local
    line of what the trend leaves at the same hour of the period, ``cycles`` periods either way,
    centred per period from the first hour on (an unfinished one belongs to the last).  After each of ``robust_rounds`` rounds an hour's weight becomes
    (1 − (r / 6·median|r|)²)² of its residual r, 0 from six medians on, and all is fitted
    again: an outlier loses its say in trend and season and stays in its own residual.

    A series is one key's hours, bounded by the calendar; keys are dealt over the tasks, and no
    series leaves the JVM.  Each round is written once, as the median and the next fit both read it.
    Null values count as 0 and repeated hours are added up; an empty series has no rows.
    """
    keys = tuple(keys)
    series = materialize(series.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.sum(value).alias("_v")))
    span = series.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    cal = span.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                      F.posexplode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias("_t", "_ts"))
    same = [F.col(ts) == F.col("_ts"), *[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]]
    x = cal.join(series, same, "left").select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_ts").alias(ts), F.col("_t").cast("double").alias("_t"),
        F.coalesce("_v", F.lit(0)).cast("double").alias("observed"), F.lit(0.0).alias("trend"), F.lit(0.0).alias("seasonal"),
        F.lit(1.0).alias("weight"))
    whole = F.floor(F.count(F.lit(1)).over(Window.partitionBy(*keys)) / period)
    x = x.withColumn("_c", F.least(F.floor(F.col("_t") / period), F.greatest(whole - 1, F.lit(0))))
    near = Window.partitionBy(*keys).orderBy("_t").rowsBetween(-trend_span, trend_span)
    phase = Window.partitionBy(*keys, "_p").orderBy("_t").rowsBetween(-cycles, cycles)
    r, t, w = F.col("observed") - F.col("trend") - F.col("seasonal"), F.col("_t"), F.col("weight")
    for step in range(robust_rounds + 1):
        for _ in range(inner):
            x = x.withColumn("trend", local_line(F.col("observed") - F.col("seasonal"), w, t, near))
            x = x.withColumn("_p", F.pmod(t, F.lit(float(period))))
            x = x.withColumn("seasonal", local_line(F.col("observed") - F.col("trend"), w, t, phase))
            x = x.withColumn("seasonal", F.col("seasonal") - F.avg("seasonal").over(Window.partitionBy(*keys, "_c")))
        if step == robust_rounds:
            break
        x = materialize(x)
        limit = x.groupBy(*keys).agg((6 * F.median(F.abs(r))).alias("_s"))
        if keys:
            limit = limit.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_s")
            same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
            x = x.join(limit, same).drop(*[f"_k{i}" for i in range(len(keys))])
        else:
            x = x.withColumn("_s", limit.scalar())
        share = F.try_divide(F.abs(r), F.col("_s"))
        x = x.withColumn("weight", F.when(F.col("_s") == 0, (r == 0).cast("double")).when(
            share < 1, F.pow(1 - share * share, F.lit(2.0))).otherwise(0.0)).drop("_s")
    return x.select(*keys, ts, "observed", "trend", "seasonal", r.alias("resid"), "weight")


# ---------------------------------------------------------------- Kendall rank correlation

def kendall_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Kendall τ-b (pandas ``corr(method='kendall')``) for several column
    pairs at once → (x_col, y_col, n, tau); rows with a NULL in either column of a
    pair are dropped for that pair.

    No pair of rows is ever generated.  All column pairs are melted into one
    (pair, x, y) frame and handled by the same keyed plan.  Rows are
    compressed to distinct (x, y) points with weights; p is x − min(x) for an
    integer x column (τ is symmetric, so a pair's integer column is put on the x
    side) and otherwise the dense rank of x (a distributed prefix sum); the
    discordant weight D = Σ w_i·w_j over
    x_i < x_j with y_i > y_j is a weighted inversion count, split by the
    merge-sort levels of p: at level L the pair (i, j) meets in block
    p >> (L+1), i on the left half and j on the right (equal x never meet).  Per (pair, level,
    block, y) the left and right weights are aggregated and one bucketed prefix
    sum over −y gives, for every right weight, the left weight above it.  Work
    is O(P·log P) rows for P distinct points; every window holds one value
    range of one block.  Ties: n1 (x), n2 (y), n3 (both) from aggregations;
    n_c = n0 − n1 − n2 + n3 − D; τ_b = (n_c − D) / √((n0 − n1)(n0 − n2)).
    """
    from cohortia.functions.ranks import prefix_sum

    # τ is symmetric: put an integer column on the x side when the pair has one, so
    # x − min(x) is already an order-preserving position (no rank pass needed)
    integral = {f.name for f in df.schema.fields
                if f.dataType.typeName() in ("long", "integer", "short", "byte")}
    plan = [((b, a) if a not in integral and b in integral else (a, b)) for a, b in pairs]
    int_pairs = [i for i, (a, _) in enumerate(plan) if a in integral]
    rank_pairs = [i for i in range(len(plan)) if i not in int_pairs]
    melted = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"),
                 F.col(b).cast("double").alias("y")) for i, (a, b) in enumerate(plan)]))
    d = df.select(melted.alias("t")).select("t.*").where(F.col("x").isNotNull() & F.col("y").isNotNull())
    # distinct weighted points feed every branch below: written once, read by all
    pts = materialize(d.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("w")))
    per_x = pts.groupBy("pair", "x").agg(F.sum("w").alias("tx"))
    # per pair (one row per column pair: bounded): weights, joint ties, x range, levels
    per_pair = pts.groupBy("pair").agg(
        F.sum("w").cast("double").alias("n"), F.countDistinct("x").alias("n_x"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"),
        F.sum(F.col("w").cast("double") * (F.col("w") - 1) / 2).alias("n3"))
    span = F.when(F.col("pair").isin(*int_pairs) if int_pairs else F.lit(False),
                  F.col("x_max") - F.col("x_min") + 1).otherwise(F.col("n_x").cast("double"))
    levels = F.greatest(F.ceil(F.log2(span)).cast("int"), F.lit(1))
    meta = F.broadcast(per_pair.select("pair", "x_min", levels.alias("levels")))
    parts = []
    if int_pairs:   # integer x: p = x − min(x); equal x share p, so they never meet
        parts.append(pts.where(F.col("pair").isin(*int_pairs)).join(meta, "pair").select(
            "pair", "y", "w", (F.col("x") - F.col("x_min")).cast("long").alias("p"), "levels"))
    if rank_pairs:  # other x: p = dense rank of x (distributed prefix sum over distinct x)
        ranks = prefix_sum(materialize(per_x.where(F.col("pair").isin(*rank_pairs)).select("pair", "x", F.lit(1).alias("one"))),
                           "x", "one", ("pair",), out="p").select("pair", "x", "p")
        parts.append(pts.where(F.col("pair").isin(*rank_pairs)).join(ranks, ["pair", "x"])
                     .join(meta, "pair").select("pair", "y", "w", "p", "levels"))
    pos = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    lv = pos.select("pair", "y", "w", "p",
                    F.explode(F.sequence(F.lit(0), F.col("levels") - 1)).alias("level"))
    lv = lv.select("pair", "level", "y", "w", F.expr("shiftright(p, level + 1)").alias("blk"),
                   F.expr("shiftright(p, level) & 1").alias("side"))
    cells = materialize(lv.groupBy("pair", "level", "blk", "y")
                        .agg(F.sum(F.when(F.col("side") == 0, F.col("w")).otherwise(0)).alias("lw"),
                             F.sum(F.when(F.col("side") == 1, F.col("w")).otherwise(0)).alias("rw"))
                        .withColumn("neg_y", -F.col("y")))
    above = prefix_sum(cells, "neg_y", "lw", ("pair", "level", "blk"), out="left_above")
    disc = above.groupBy("pair").agg(F.sum(F.col("rw").cast("double") * F.col("left_above")).alias("D"))
    n1 = per_x.groupBy("pair").agg(F.sum(F.col("tx").cast("double") * (F.col("tx") - 1) / 2).alias("n1"))
    n2 = (pts.groupBy("pair", "y").agg(F.sum("w").cast("double").alias("ty"))
          .groupBy("pair").agg(F.sum(F.col("ty") * (F.col("ty") - 1) / 2).alias("n2")))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    r = per_pair.join(n1, "pair").join(n2, "pair").join(disc, "pair", "left")
    n0 = F.col("n") * (F.col("n") - 1) / 2
    D = F.coalesce(F.col("D"), F.lit(0.0))
    nc = n0 - F.col("n1") - F.col("n2") + F.col("n3") - D
    tau = F.try_divide(nc - D, F.sqrt((n0 - F.col("n1")) * (n0 - F.col("n2"))))
    return r.select(names[F.col("pair")]["a"].alias("x_col"), names[F.col("pair")]["b"].alias("y_col"),
                    F.col("n").cast("long").alias("n"), tau.alias("tau"))


def kendall_tau(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall τ-b of one column pair → one row (x_col, y_col, n, tau)."""
    return kendall_pairs(df, [(x, y)])


def kendall_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """The Kendall τ-b matrix in long form (x_col, y_col, n, tau): both triangles
    from one keyed computation over all column pairs, plus the unit diagonal."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    df = materialize(df.select(*cols))          # read by the pairs and by the diagonal counts
    t = kendall_pairs(df, pairs)
    both = t.select(F.explode(F.array(
        F.struct("x_col", "y_col", "n", "tau"),
        F.struct(F.col("y_col").alias("x_col"), F.col("x_col").alias("y_col"), "n", "tau"))).alias("m")
    ).select("m.*")
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    diag = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("x_col"), F.lit(c).alias("y_col"), F.col(c).alias("n"),
                 F.lit(1.0).alias("tau")) for c in cols])).alias("d")).select("d.*")
    return both.unionByName(diag)
