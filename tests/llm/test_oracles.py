"""Queries of the corpus operators against their DuckDB SQL at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from barwright.llm.sql import ORACLES
from check_oracle import rows_of, type_mismatches
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    got = entry_mod.queries()[name](spark, SF)
    assert type_mismatches(got, con, ORACLES[name]) == []
    assert rows_of(got.toPandas()) == rows_of(con.execute(ORACLES[name]).df())
