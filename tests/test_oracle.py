"""Every query with SQL gives what DuckDB gives on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from roomtrace.plans.catalog import QUERIES
from roomtrace.plans.oracle import ORACLE

SF = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(str(row[n]) for n in names) for row in table.to_pylist())


def types(table):
    return {f.name: str(f.type) for f in table.schema}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    assert normal(got) == normal(want)
    assert types(got) == types(want)
    assert got.num_rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() == 21
