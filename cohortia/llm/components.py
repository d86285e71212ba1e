"""Connected components by alternating large-star and small-star rounds.

DataFrame operations only.  Each round sends every node's neighbours to the
smallest node it can see; the edge set ends as one edge per node to the
smallest node of its component, after a number of rounds that grows with the
logarithm of the component size.  A hub's edges are a hot key: its minimum is
aggregated map-side and stored, and the join back is between two plain shuffled
inputs, which adaptive execution splits (or broadcasts the minima when their
stored size is below the session's threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.scratch import store


def _to_minimum(edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    low = store(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    return low, edges.join(low, "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Edges (``a``, ``b``) -> one row (node, component) per node of a proper edge;
    ``component`` is the smallest node.  Null ends, loops and repeats are ignored;
    nodes without an edge do not appear."""
    e = store(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        _, j = _to_minimum(both, "large")
        large = store(j.where(F.col("v") > F.col("u"))
                      .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "edges")
        low, j = _to_minimum(large, "small")
        small = j.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
