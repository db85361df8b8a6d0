"""Every registered query against its DuckDB oracle at sf0.001 (row count, columns, values)."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from barwright.plans import catalog
from barwright.plans.datasets import TABLES
from check_oracle import rows_of
from tests.conftest import SF

#: the library's own queries; an optional subpackage tests its own
QUERIES = {k: v for k, v in entry_mod.queries().items() if k in catalog.QUERIES}
SQLS = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(SQLS)
    assert rows_only == set()


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "macd_signal" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQLS:
        assert len(got) >= 0
        return
    exp = con.execute(SQLS[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert rows_of(got) == rows_of(exp)
