"""Registered queries against their DuckDB SQL on the given tables."""

from __future__ import annotations

import duckdb
import pytest

from surveymill.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    expected = con.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, expected.fetchall()))
