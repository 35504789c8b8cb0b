"""The queries that SQL can express give what DuckDB gives."""

from __future__ import annotations

import duckdb
import pytest

from roomtrace.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def normal(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(str(row[n]) for n in names) for row in table.to_pylist())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toArrow(), con.sql(ORACLE[name]).to_arrow_table()
    assert normal(got) == normal(want)
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
