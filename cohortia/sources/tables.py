"""Readers for the two event tables and any other named table.

``feed_actions`` and ``message_actions`` are plain DataFrames with the columns
documented in FIXTURES.md.  They can come from parquet (``read_parquet``), a
catalog table (``spark.table``) or JDBC (``read_jdbc``); the operators only see
the DataFrame, so Catalyst prunes columns and pushes date filters into each of
those scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FEED_COLUMNS = ["user_id", "post_id", "action", "time", "gender", "age", "os",
                "source", "country", "city", "exp_group"]
MESSAGE_COLUMNS = ["user_id", "reciever_id", "time", "gender", "age", "os",
                   "source", "country", "city", "exp_group"]


def read_parquet(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``{base}/{name}.parquet`` (a file or a directory of part files)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; partition pruning applies when it is date-partitioned."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, table: str, conf_prefix: str = "cohortia.jdbc") -> DataFrame:
    """A JDBC table whose url/user/password come from Spark conf, never from code.

    ``{conf_prefix}.url``, ``.user``, ``.password``, ``.driver`` and optionally
    ``.partitionColumn/.lowerBound/.upperBound/.numPartitions`` for parallel reads.
    """
    opts = {"dbtable": table}
    for key in ("url", "user", "password", "driver", "partitionColumn",
                "lowerBound", "upperBound", "numPartitions", "fetchsize"):
        val = spark.conf.get(f"{conf_prefix}.{key}", None)
        if val is not None:
            opts[key] = val
    return spark.read.format("jdbc").options(**opts).load()


def preview(df: DataFrame, n: int = 5, order_by: tuple = ()) -> DataFrame:
    """``SELECT * … LIMIT n`` (S3): a bounded peek, the limit is the feature.  With ``order_by`` the
    first n rows of that order (O1), planned as a top n of each task."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
