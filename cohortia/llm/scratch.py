"""Intermediate tables in the folder that driver and executors share.

``spark.checkpoint.dir`` names that folder on a cluster.  A reliable
``checkpoint()`` computes its input twice (once to count, once to write), so
intermediates are written once as compressed Parquet and read back: the
lineage is cut, a lost executor costs nothing that was written, and the planner
knows the size of what it joins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder; a temporary one only for ``local[...]`` sessions (tests)."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="llm-scratch-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
