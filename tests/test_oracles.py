"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck_connect

_SQL = E.oracle_sql()
_NAMES = sorted(_SQL)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", _NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, _SQL[name], SF_SMALL, con)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["feature", "category", "outcome_rate", "n", "rank"]
