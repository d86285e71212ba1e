"""Distributed prefix sums, dense indexes and exact quantiles.

A global ``Window.orderBy`` without ``partitionBy`` moves every row into one
task.  Instead the ordered column is cut into ``buckets`` ranges at its own
quantiles, found by one pass of a mergeable quantile sketch, so that ranges hold
about the same number of rows whatever the distribution.  The cuts are fixed in the
plan as one literal: the totals of the ranges and the windows inside them see the
same ranges.  Each range's total is summed, the totals' running offsets are computed
over the tiny (keys × buckets) table, and the running sum inside a range is a
window partitioned by (keys, bucket).  Every task holds one range, never the whole column.

The inputs here are already de-duplicated (one row per distinct value, or
per user), so a hot value cannot overload a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortia.session import materialize

DEFAULT_BUCKETS = 1024
ACCURACY = 10           # a cut is off by less than 1 / (ACCURACY * buckets) of the rows on either side


def range_cuts(df: DataFrame, order_col: str, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Array literal of the distinct cuts (fewer than ``buckets``) between ranges of about the
    same number of rows; only the cuts reach the driver."""
    kind = df.schema[order_col].dataType.simpleString()

    def literal(values) -> Column:          # one foldable expression, however many values
        return F.split(F.lit(",".join(str(v) for v in values)), ",")

    probs = literal(i / buckets for i in range(1, buckets)).cast("array<double>")
    cuts = df.agg(F.array_distinct(F.percentile_approx(order_col, probs, ACCURACY * buckets))).first()[0] or []
    return literal(cuts).cast(f"array<{kind}>") if cuts else F.array().cast(f"array<{kind}>")


def range_index(col: str | Column, cuts: Column) -> Column:
    """Number of ``cuts`` that are ≤ the value, by halving: 0 for values before the first cut."""
    c = F.col(col) if isinstance(col, str) else col
    lo, hi = F.lit(0), F.size(cuts)

    def halve(state, _):
        mid = ((state["lo"] + state["hi"]) / 2).cast("int")
        done = state["lo"] >= state["hi"]
        right = F.get(cuts, mid) <= c
        return F.struct(F.when(~done & right, mid + 1).otherwise(state["lo"]).alias("lo"),
                        F.when(~done & ~right, mid).otherwise(state["hi"]).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1.0)).cast("int"))
    return F.aggregate(steps, F.struct(lo.alias("lo"), hi.alias("hi")), halve, lambda s: s["lo"])


def prefix_sum(df: DataFrame, order_col: str, sum_col: str, keys: tuple[str, ...] = (),
               out: str = "cum_before", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``out`` = Σ ``sum_col`` over rows of the same ``keys`` with a smaller
    ``order_col`` (``order_col`` must be unique within ``keys``).

    The cuts are those of the whole column: a range of one key is part of a range of all rows,
    so no window holds more than that, and keys of few rows need no cuts of their own.
    ``df`` is read by the sketch, the totals and the windows: pass a written frame.
    """
    keys = tuple(keys)
    x = df.withColumn("_b", range_index(order_col, range_cuts(df, order_col, buckets)))
    tot = x.groupBy(*keys, "_b").agg(F.sum(sum_col).alias("_bt"))
    off = tot.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_ob"), F.coalesce(
        F.sum("_bt").over(Window.partitionBy(*keys).orderBy("_b")
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    same = [F.col("_b") == F.col("_ob"), *[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]]
    x = x.join(off, same)               # a null key is a key
    inner = Window.partitionBy(*keys, "_b").orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, -1)
    return (x.withColumn(out, F.col("_off") + F.coalesce(F.sum(sum_col).over(inner), F.lit(0)))
            .drop("_b", "_ob", "_off", *[f"_k{i}" for i in range(len(keys))]))


def dense_index(df: DataFrame, order_col: str, keys: tuple[str, ...] = (), out: str = "idx",
                buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """0-based position of each row by ``order_col`` within ``keys`` (unique order values)."""
    return prefix_sum(df.withColumn("_one", F.lit(1)), order_col, "_one", keys, out, buckets) \
        .drop("_one")


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: tuple[str, ...] = (),
                    buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``percentile_cont``) per ``keys``.

    Returns (keys…, prob, quantile).  Works from distinct-value counts and
    their running totals, so no task holds a whole group's values.
    """
    keys = tuple(keys)
    cnt = materialize(df.where(F.col(value).isNotNull()).groupBy(*keys, value)
                      .agg(F.count(F.lit(1)).alias("_n")))      # read by every pass below
    cum = prefix_sum(cnt, value, "_n", keys, "_cb", buckets)
    tot = cnt.groupBy(*keys).agg(F.sum("_n").alias("_tot"))
    cum = cum.join(tot, list(keys)) if keys else cum.withColumn(
        "_tot", cnt.select(F.sum("_n")).scalar())
    # one array literal of probabilities and one lambda: the expression size does not
    # grow with the number of probabilities
    probs_lit = F.lit([float(p) for p in probs])
    r0 = lambda p: F.floor((F.col("_tot") - 1) * p)
    lo, hi = F.col("_cb"), F.col("_cb") + F.col("_n")
    hits = F.filter(probs_lit, lambda p: ((r0(p) >= lo) & (r0(p) < hi))
                    | ((r0(p) + 1 >= lo) & (r0(p) + 1 < hi)))
    hit = cum.select(*keys, value, "_cb", "_n", "_tot", F.explode(hits).alias("prob"))
    r = F.floor((F.col("_tot") - 1) * F.col("prob"))
    per = (hit.groupBy(*keys, "prob")
           .agg(F.max(F.when((r >= lo) & (r < hi), F.col(value))).alias("_v0"),
                F.max(F.when((r + 1 >= lo) & (r + 1 < hi), F.col(value))).alias("_v1"),
                F.max("_tot").alias("_tot")))
    h = (F.col("_tot") - 1) * F.col("prob")
    frac = h - F.floor(h)
    v1 = F.coalesce(F.col("_v1"), F.col("_v0"))
    return per.select(*keys, "prob",
                      (F.col("_v0") + frac * (v1 - F.col("_v0"))).cast("double").alias("quantile"))
