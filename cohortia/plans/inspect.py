"""Physical-plan summaries (from ``explain('formatted')``) for plan reviews."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

JOIN_KINDS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
              "CartesianProduct")


def formatted_plan(df: DataFrame) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def plan_summary(df: DataFrame) -> dict:
    """Shuffles, joins, windows, scans (pushed filters / read columns) and Python evals."""
    text = formatted_plan(df)
    head = text.split("\n\n(")[0]
    nodes = re.findall(r"\((\d+)\) (\w+)", text)
    kinds = [k for _, k in nodes]
    scans = []
    for block in re.split(r"\n\s*\n", text):
        block = block.strip()
        if re.match(r"\(\d+\) Scan parquet", block):
            info = dict(line.split(": ", 1) for line in block.split("\n")[1:] if ": " in line)
            scans.append({"location": info.get("Location", "").split("/")[-1].rstrip("]"),
                          "pushed": info.get("PushedFilters", "[]"),
                          "columns": info.get("ReadSchema", "")})
    return {
        "exchanges": head.count("Exchange") - head.count("ReusedExchange"),
        "reused_exchanges": head.count("ReusedExchange"),
        "joins": {k: head.count(k) for k in JOIN_KINDS if head.count(k)},
        "windows": head.count("Window"),
        "python": head.count("ArrowEvalPython") + head.count("BatchEvalPython"),
        "subqueries": len(set(re.findall(r"Subquery:(\d+)", text))),
        "scans": scans,
        "scan_nodes": head.count("Scan parquet"),
        "nodes": len(kinds),
    }
