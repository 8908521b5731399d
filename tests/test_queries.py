"""Every registered query on the smallest data, against its SQL where it has one."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{SF}/{name}')")
    return con


def plain(value):
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio"):
        number = float(value)
        return repr(number + 0.0) if math.isfinite(number) else str(number)
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) and (rows or name in {"rep_05_gated_histogram"})
        return
    result = duck.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    assert canonical(df.columns, rows) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120
