"""Every registered query against its SQL, on whole tables."""

import math
import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float, Decimal)):
        if isinstance(value, float) and math.isnan(value):
            return (2, "nan")
        return (2, repr(float(value)))
    if isinstance(value, datetime):
        return (3, value.isoformat())
    return (4, str(value))


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{FOLDER}/events.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in result.collect()]
    want = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(result.columns) == sorted(want.columns)
    expected = want.fetchall()
    assert len(got) == len(expected) > 0
    assert _canonical(result.columns, got) == _canonical(want.columns, expected)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
