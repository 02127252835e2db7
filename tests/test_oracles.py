"""Every registered query with SQL against DuckDB on the same tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

from barloom.plans import events, sections, series, tables  # noqa: F401
from barloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    expected = db.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got.columns, got.collect()) == rows(expected.columns, expected.fetchall())


def test_every_market_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
