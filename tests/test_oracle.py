"""Every registry key against its independent DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from oracle_harness import compare, duck
from paceline.plans.queries import all_queries

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_key_has_an_oracle():
    assert set(all_queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    problems, n_spark, n_duck = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_ORACLE)
    assert not problems, "\n".join(problems)
    assert n_spark > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "quarter", "month", "month_name", "event_country", "event_type",
                          "unique_events", "starts"]
