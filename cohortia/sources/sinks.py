"""Sinks: the daily fact table, TSV exports and formatted report rows.

Writes are idempotent: the fact table is partitioned by ``event_date`` and
written with dynamic partition overwrite, so a retried or re-run day replaces
its own partition instead of appending duplicates (the reference appends).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortia.functions.metrics import fmt_thousands
from cohortia.functions.timefn import as_date

FACT_SORT = ("gender", "age", "os")


def write_fact(df: DataFrame, path: str, partition_col: str = "event_date",
               sort_cols: tuple[str, ...] = FACT_SORT, files_per_partition: int | None = None) -> None:
    """Write a date-partitioned parquet fact table, replacing only the dates in ``df``.

    Rows are clustered by date (one shuffle on the partition column, so each
    date is written by one task, or by ``files_per_partition`` tasks when a date
    is large — a salt from the other columns spreads it) and sorted within
    files by ``sort_cols``, the analogue of MergeTree's ORDER BY.
    """
    if files_per_partition:
        others = [c for c in df.columns if c != partition_col]
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in others]), F.lit(files_per_partition))
        out = df.repartition(partition_col, salt)
    else:
        out = df.repartition(partition_col)
    (out.sortWithinPartitions(partition_col, *sort_cols)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).parquet(path))


def write_fact_table(df: DataFrame, table: str, partition_col: str = "event_date") -> None:
    """Create-if-absent + load of a catalog table partitioned by date.

    Only the dates in ``df`` are replaced; ``insertInto`` takes the overwrite mode from
    the session, not from a writer option, so it is set for the write alone.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(mode, before)
    else:
        df.write.partitionBy(partition_col).format("parquet").saveAsTable(table)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_day(df: DataFrame, path: str, on_day, run: int, partition_col: str = "event_date",
             sort_cols: tuple[str, ...] = FACT_SORT, tasks: int | None = None) -> bool:
    """S4/S5 with a version guard: load one day of ``df`` as run number ``run``; False if that
    (day, run) is loaded already, and nothing is written.

    A run writes its own folder ``data/<day>/run=<run>`` and then one row to ``log/<day>/run=<run>``;
    readers go by the log, of which the largest run of a day counts.  So a writer that dies leaves
    the day as it was, the same run may be started again, two writers never share a folder, and a late
    run with a smaller number doesn't replace a newer one.  No setting of the session is touched.
    Rows of other days are left out; a day without rows is loaded as empty.
    """
    spark, d = df.sparkSession, as_date(on_day)
    at = f"{partition_col}={d}/run={int(run)}"
    if not _log(spark, path, partition_col).where((F.col(partition_col) == F.lit(d)) & (F.col("run") == int(run))).isEmpty():
        return False
    rows = df.where(F.col(partition_col) == F.lit(d)).drop(partition_col)
    rows = rows.repartition(tasks) if tasks else rows.coalesce(1)
    order = [c for c in sort_cols if c in rows.columns]
    rows = rows.sortWithinPartitions(*order) if order else rows
    rows.write.mode("overwrite").parquet(f"{path}/data/{at}")
    written = spark.read.schema(rows.schema).parquet(f"{path}/data/{at}").agg(F.count(F.lit(1)).alias("rows"))
    written.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/{at}")
    return True


def _log(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """(rows, day, run) of all loads; empty where nothing was loaded yet."""
    schema = f"rows bigint, {partition_col} date, run bigint"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/log")


def read_loaded(spark: SparkSession, path: str, partition_col: str = "event_date") -> DataFrame:
    """The newest loaded run of every day.  The log tells its folders, one for each day, and only these
    are listed and read; the newest runs (a row for each day of the calendar) pass the driver."""
    newest = _log(spark, path, partition_col).groupBy(partition_col).agg(F.max("run").alias("run")).collect()
    folders = [f"{path}/data/{partition_col}={r[partition_col]}/run={r.run}" for r in newest]
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("run")


def export_tsv(df: DataFrame, path: str) -> None:
    """TSVWithNames — tab separated with a header row."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def report_rows(df: DataFrame, metric_cols: list[str], key: str = "day",
                date_format: str = "dd.MM.yyyy") -> DataFrame:
    """One text row per (key, metric): '12 345'-style numbers and dd.MM.yyyy dates."""
    stacked = df.select(F.date_format(key, date_format).alias(key), F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metric_cols
    ])).alias("m")).select(key, "m.metric", "m.value")
    return stacked.select(key, "metric", "value",
                          F.concat_ws(" - ", F.col("metric"), fmt_thousands(F.col("value"), 0)).alias("text"))
