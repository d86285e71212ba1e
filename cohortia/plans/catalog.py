"""Registered queries: one Spark plan and (when SQL can express it) one oracle each.

Each entry reads the whole given tables from ``sf_dir`` and applies one
operator with fixed parameters.  ``queries()`` / ``oracle_sql()`` in
``__spark_entry__`` expose this registry to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortia.functions.metrics import round_doubles
from cohortia.plans.oracle import build

AS_OF = dt.date(2024, 1, 31)          # "today" of the test data; yesterday = 2024-01-30
YESTERDAY = AS_OF - dt.timedelta(days=1)
EARLY_DAY = dt.date(2024, 1, 3)       # a day on which new users still exist at sf0.01

_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = (run, build(sql, doubles) if sql is not None else None)
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


def _load() -> None:
    # importing the modules registers their queries
    from cohortia.plans import (q_activity, q_anomaly, q_cohorts, q_eda, q_etl,  # noqa: F401
                                q_experiment, q_streaming)
