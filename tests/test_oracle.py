"""Every registered query equals its DuckDB oracle at sf0.01 (values and column types)."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tests.harness import compare, compare_types, duck, duck_types, spark_types


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    sdf = queries()[name](spark, SF_SMALL)
    rel = con.sql(oracle_sql()[name])
    sp, ora = sdf.toPandas(), rel.df()
    assert compare(sp, ora) is None, compare(sp, ora)
    assert compare_types(spark_types(sdf.schema), duck_types(rel)) is None


def test_every_query_has_a_callable_and_most_have_oracles():
    from __spark_entry__ import oracle_sql, queries
    from cohortia.plans.catalog import all_oracles, all_queries
    assert set(oracle_sql()) <= set(queries())
    qs, sq = all_queries(), all_oracles()
    assert set(sq) <= set(qs)
    assert len(sq) >= 0.9 * len(qs)


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"cohort", "days_distance", "num_of_users", "retention_rate"}
