"""Registered queries against SQL on the same tables, and the guard of the registry."""

import duckdb
import pytest

import __spark_entry__
from barloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, expected = queries.queries()[name](spark, SF), db.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    key = lambda columns, rows: sorted(str([r[columns.index(c)] for c in sorted(columns)]) for r in rows)
    assert key(got.columns, [tuple(r) for r in got.collect()]) == key(expected.columns, expected.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)} and "pipeline" in names
    assert set(queries.oracle_sql()) <= names
