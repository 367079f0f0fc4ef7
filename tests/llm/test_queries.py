"""Registered queries: SQL oracles where there are some, and clean imports."""

import pytest

import __spark_entry__ as entry
from bluelines.llm import queries

SF = "/root/testdata/sf0.001"


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, got) == rows(cols, cur.fetchall())
