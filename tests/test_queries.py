"""Every query that has SQL against DuckDB, on the smallest test tables."""

import os

import pandas as pd
import pytest

from gridfold import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


def plain(value):
    if value is None or value is pd.NA or value != value:
        return ""
    return str(int(value)) if isinstance(value, float) and value == int(value) else str(value)


def rows(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    ours, sql = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(sql.columns)
    assert rows(ours) == rows(sql)


def test_book_fold_runs(spark):
    assert queries.book_fold(spark, SF).count() > 0


def test_plans_stay_as_meant(spark):
    """The as-of grid has no join and one exchange; semi joins push their columns down to the scan."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    grid = plan(queries.asof_grid_hourly(spark, SF))
    assert "Join" not in grid and grid.count("Exchange ") == 1
    semi = plan(queries.semi_join_ids(spark, SF))
    assert "PushedFilters: [IsNotNull(p_size), LessThan(p_size,10)" in semi and "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in semi
