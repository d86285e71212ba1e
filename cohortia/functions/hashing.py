"""Deterministic pseudo-random draws and hash buckets.

Resampling never calls ``rand()``: a draw is a pure function of its keys
(seed, group, user, replicate or draw number), so a lost executor recomputes
the same draws and an SQL engine can reproduce them.  ``draw_state`` hashes the
slow keys (seed, group, user) with md5 into two 31-bit states, once per row
before replicates are generated; ``draw`` mixes each state with the fast key
(replicate) by Park–Miller multiplications modulo the prime 2^31−1 and two
xor-shifts, and joins both streams into one integer in [0, (2^31−1)²), 62 bits.
Every intermediate stays below 2^62, exact in 64-bit arithmetic.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F

MOD = 2147483647        # 2^31 − 1
DRAWS = MOD * MOD       # a draw is in [0, DRAWS)

# Multipliers of the mixing steps of the two streams.
MIX = ((16807, 69621, 40692, 48271), (48271, 40692, 16807, 69621))


def draw_state(seed: int, *keys: Column) -> Column:
    """Struct (a, b) of two integers in [0, 2^31−1) from a seed and any keys."""
    h = F.md5(F.concat_ws("|", F.lit(str(int(seed))), *[k.cast("string") for k in keys]))
    part = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long") % MOD
    return F.struct(part(1).alias("a"), part(9).alias("b"))


def _stream(state: Column, key: Column, mix: tuple[int, ...]) -> Column:
    x = (state + F.pmod(key.cast("long"), F.lit(MOD)) * mix[0]) % MOD
    x = (x * mix[1]) % MOD
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * mix[2]) % MOD
    x = x.bitwiseXOR(F.shiftright(x, 13))
    return (x * mix[3]) % MOD


def draw(state: Column, key: Column) -> Column:
    """Integer in [0, DRAWS) from a ``draw_state`` and one more integer key."""
    return _stream(state["a"], key, MIX[0]) * MOD + _stream(state["b"], key, MIX[1])


def draw_index(x: Column, size: Column) -> Column:
    """Position in [0, size) from the draw ``x``; every position of a pool of any size can be
    hit, with a relative bias below size / 2^62."""
    return F.pmod(x, size.cast("long"))


def poisson_thresholds(mean: float = 1.0) -> list[int]:
    """T_k = ceil(CDF_Poisson(k) · DRAWS) for every k whose threshold is below DRAWS;
    weight = #{k: x ≥ T_k}, so no weight that a draw can reach is cut off."""
    with localcontext() as ctx:
        ctx.prec = 60
        acc, term, k, out = Decimal(0), Decimal(-mean).exp(), 0, []
        while True:
            acc += term
            t = int((acc * DRAWS).to_integral_value(ROUND_CEILING))
            if t >= DRAWS:
                return out
            out.append(t)
            k += 1
            term = term * Decimal(mean) / k


def poisson_weight(x: Column, mean: float = 1.0) -> Column:
    """Poisson(mean) weight by inverse CDF of the draw ``x``."""
    thresholds = poisson_thresholds(mean)
    w = F.when(x < F.lit(thresholds[0]), F.lit(0))
    for k, t in enumerate(thresholds[1:], 1):
        w = w.when(x < F.lit(t), F.lit(k))
    return w.otherwise(F.lit(len(thresholds)))


def poisson_table(mean: float) -> tuple[int, list[int]]:
    """(low, thresholds): a draw x > 0 gives the weight low + #{t in thresholds: x ≥ t}, which is
    the inverse CDF; weights below ``low`` have less chance than one draw."""
    t = poisson_thresholds(mean)
    low = sum(v <= 1 for v in t)
    return low, t[low:]


def count_not_above(values: Column, x: Column, steps: Column) -> Column:
    """#{v in the sorted array ``values``: v ≤ x} by bisection; ``steps`` is the array of the
    powers of two, largest first, that the search adds up."""
    return F.aggregate(steps, F.lit(0), lambda pos, step: F.when(
        F.get(values, pos + step - 1) <= x, pos + step).otherwise(pos))


def md5_bucket(col: str | Column, n: int) -> Column:
    """Hash bucket in [0, n): first 32 bits of md5(decimal text of col), mod n.

    Reproducible in SQL engines (xxHash64 seeds differ between engines).
    """
    c = F.col(col) if isinstance(col, str) else col
    h = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n)).cast("int")


def md5_bucket_sql(col: str, n: int) -> str:
    return f"CAST((('0x' || substr(md5(CAST({col} AS VARCHAR)), 1, 8))::BIGINT % {n}) AS INTEGER)"


def xxhash_bucket(col: str | Column, n: int) -> Column:
    """``xxHash64(col) % n`` as in the reference (Spark's xxhash64 seed is 42)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
