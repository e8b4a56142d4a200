"""Every registered query against its DuckDB oracle, on the smallest given tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from checks.catalog import QUERIES
from checks.oracle import ORDERS, oracles
from surveymill.plans.statements import STATEMENTS

SF = "/root/testdata/sf0.001"
ORDERED_SF = "/root/testdata/sf0.01"  # enough rows for every order to show
TABLES = "customer documents events lineitem orders part".split()
ORACLES = oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def _key(value):
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


def test_registration():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(tuple(map(_key, row)) for row in frame.select(*columns).collect())
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    assert got == sorted(tuple(_key(row[i]) for i in order) for row in result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).columns == ["survey_year", "job_family", "professionals", "share_pct"]


@pytest.mark.parametrize("name", sorted([*ORDERS, *(f"sql_{name}" for name in STATEMENTS if name in ORDERS)]))
def test_order(spark, duck, name):
    """Rows come in the order asked for: the sort keys of the rows as they come are those of the sorted oracle."""
    order = ORDERS[name.removeprefix("sql_")]
    keys = [part.split()[0] for part in order.split(", ")]
    got = [tuple(map(_key, row)) for row in QUERIES[name](spark, ORDERED_SF).select(keys).collect()]
    tables = duckdb.connect()
    for table in TABLES:
        tables.execute(f"CREATE VIEW {table} AS SELECT * FROM '{ORDERED_SF}/{table}.parquet'")
    expected = tables.execute(f"SELECT {', '.join(keys)} FROM ({ORACLES[name]}) o ORDER BY {order}").fetchall()
    assert got == [tuple(map(_key, row)) for row in expected]
    assert len(set(got)) > 1 or name.endswith("q_region_sudeste")
