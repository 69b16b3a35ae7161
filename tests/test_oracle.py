"""Every registered query with an oracle: Spark result == DuckDB result (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], SQL[name], SF)
    assert info["ok"], info


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "mean_implicit_score" in df.columns


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0
