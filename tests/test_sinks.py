from __future__ import annotations

import datetime as dt

from cohortia.sources.sinks import load_day, read_loaded, write_fact_table


def test_reloading_a_day_keeps_the_others(spark, tmp_path):
    def day(d, v):
        return spark.createDataFrame([(v, dt.date(2024, 1, d))], "value int, event_date date")

    spark.sql(f"CREATE TABLE fact_reload (value INT, event_date DATE) USING parquet PARTITIONED BY (event_date) "
              f"LOCATION '{tmp_path}/fact'")
    try:
        for d, v in ((1, 1), (2, 2), (2, 3)):
            write_fact_table(day(d, v), "fact_reload")
        assert {(r.event_date.day, r.value) for r in spark.table("fact_reload").collect()} == {(1, 1), (2, 3)}
    finally:
        spark.sql("DROP TABLE fact_reload")


def test_day_ranges_reach_the_scan(spark):
    from cohortia.functions.timefn import on_days
    t = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = t.where(on_days("ts", "2024-01-05", "2024-01-12"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def _fact(spark, *rows):
    return spark.createDataFrame([(v, dt.date(2024, 1, d)) for d, v in rows], "value int, event_date date")


def _loaded(spark, path):
    return {(r.event_date.day, r.value) for r in read_loaded(spark, path).collect()}


def test_loads_go_by_the_log(spark, tmp_path):
    path = str(tmp_path / "loads")
    assert load_day(_fact(spark, (1, 1), (2, 9)), path, "2024-01-01", run=1)         # the other day's row stays out
    assert load_day(_fact(spark, (2, 2)), path, "2024-01-02", run=5)
    assert not load_day(_fact(spark, (2, 7)), path, "2024-01-02", run=5)             # started twice
    assert load_day(_fact(spark, (2, 8)), path, "2024-01-02", run=4)                 # late and older
    assert _loaded(spark, path) == {(1, 1), (2, 2)}
    assert load_day(_fact(spark, (2, 3), (2, 4)), path, "2024-01-02", run=6)
    assert _loaded(spark, path) == {(1, 1), (2, 3), (2, 4)}
    assert load_day(_fact(spark), path, "2024-01-01", run=2)                         # a day without rows
    assert _loaded(spark, path) == {(2, 3), (2, 4)}


def test_a_killed_write_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "loads")
    load_day(_fact(spark, (1, 1)), path, "2024-01-01", run=1)
    _fact(spark, (1, 2)).drop("event_date").write.parquet(f"{path}/data/event_date=2024-01-01/run=2")   # died before the log
    assert _loaded(spark, path) == {(1, 1)}
    assert load_day(_fact(spark, (1, 3)), path, "2024-01-01", run=2)
    assert _loaded(spark, path) == {(1, 3)}


def test_only_the_newest_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "loads")
    for d in (1, 2, 3):
        for run in (1, 2):
            load_day(_fact(spark, (d, d)), path, f"2024-01-0{d}", run=run)
    files = read_loaded(spark, path).inputFiles()
    assert {f.rsplit("/data/", 1)[1].rsplit("/", 1)[0] for f in files} == {f"event_date=2024-01-0{d}/run=2" for d in (1, 2, 3)}
