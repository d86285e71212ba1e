"""Aggregate and ratio building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_if(cond: Column) -> Column:
    """countIf(cond) — also countIf(col, cond) when col is never NULL."""
    return F.count_if(cond)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL (Spark ANSI would raise)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n.cast("double"), d.cast("double"))


def ctr(likes: str | Column = "likes", views: str | Column = "views") -> Column:
    return ratio(likes, views)


def fmt_thousands(col: str | Column, decimals: int = 0) -> Column:
    """'{:,}'.format(x).replace(',', ' ') → '12 345'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(F.format_number(c, decimals), ",", " ")


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Default-fill counters after an outer join (ClickHouse join_use_nulls=0)."""
    return df.fillna(0, subset=cols)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float column (for stable comparison with an oracle)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def scalars(df: DataFrame, **aggs: Column) -> dict[str, Column]:
    """Several global aggregates of ``df`` as ONE scalar subquery (a struct).

    Each returned Column reads one field of the same subquery, which Spark
    plans once (identical subqueries are reused), so a group of moments or
    ranges costs one pass over ``df`` — no constant-key or cross join needed.
    """
    s = df.select(F.struct(*[c.alias(k) for k, c in aggs.items()])).scalar()
    return {k: s.getField(k) for k in aggs}
