"""Every registered query against its DuckDB oracle on the driver tables."""

import pytest

import __spark_entry__ as entry
from marquee.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    problems, _, _ = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["game_key", "date_key"]
