"""Every registered query against its SQL oracle (reference-form SQL in DuckDB) at sf0.001."""

import datetime
import decimal

import pytest

import __spark_entry__ as entry
from testdata import SF_SMALL

from bluelines.plans.catalogue import QUERIES

SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(cols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["linear_feature_id", "notation_id_list", "primary_notation_type",
                          "secondary_notation_types", "fwa_watershed_code", "blue_line_key",
                          "downstream_route_measure", "upstream_route_measure"]
