"""Every registered query that has SQL against it."""

import importlib

import pytest

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def normal(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = cursor.fetchall()
    found = [tuple(row) for row in result.select(*names).collect()]
    assert len(found) > 0
    assert normal(found) == normal(expected)


@pytest.mark.parametrize("name", ["sort_desc", "topn_orders", "delimited_rows", "char_count", "char_lines", "pair_latency"])
def test_order_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert [tuple(r) for r in result.select(*names).collect()] == cursor.fetchall()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 5
