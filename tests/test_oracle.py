"""Every registered query against its DuckDB oracle at sf0.01 (exact values)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF01
from datescore.plans.catalog import QUERIES
from datescore.plans.oracle import SQL
from tools.check_oracle import canon, duck, type_differences


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con: duckdb.DuckDBPyConnection, name):
    df = QUERIES[name](spark, SF01)
    s_cols, s_body = canon(df.columns, [tuple(r) for r in df.collect()])
    r = con.sql(SQL[name])
    assert type_differences(df.dtypes, r.columns, r.types) == {}
    o_cols, o_body = canon(r.columns, r.fetchall())
    assert s_cols == o_cols
    assert len(s_body) == len(o_body)
    assert s_body == o_body


def test_every_query_has_a_callable():
    assert set(SQL) == set(QUERIES) and len(QUERIES) == 41
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_name", "dep_date", "q_ratio"]
    assert df.count() > 0
