from __future__ import annotations

import pytest

from roomtrace.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


@pytest.fixture(scope="session")
def answer(spark):
    """The rows of a query on the smallest tables, computed once."""
    known = {}

    def get(name):
        if name not in known:
            known[name] = rows(QUERIES[name](spark, SF))
        return known[name]

    return get


@pytest.fixture(scope="session")
def texts():
    import duckdb

    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


#: Nulls, empty and very long texts, ties and repeated rows, and a column whose name clashes.
ODD = [
    (1, None), (2, ""), (3, "one"), (4, "the cat sat on the mat and slept there " * 400), (5, "the cat sat on the mat and slept there " * 400),
    (None, "a null id"), (7, "twice the same row"), (7, "twice the same row"), (8, "\n\n \t\n"), (9, "x" * 200_000), (10, "Grüße, 你好 ́ 🙂 end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(
        [(i, t, None, "s", 0.5, "n", [1]) for i, t in ODD],
        "doc_id bigint, text string, lang string, source string, score double, node string, labels array<int>",
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
