"""Every core query that has SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import pytest

from playweave.plans import catalog


def _rows(rows):
    return sorted(tuple(str(round(x, 6) if isinstance(x, float) else x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, data, name):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    df = catalog.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    r = con.execute(catalog.SQL[name])
    theirs = [d[0] for d in r.description]
    assert sorted(theirs) == columns
    expected = [tuple(dict(zip(theirs, x))[c] for c in columns) for x in r.fetchall()]
    assert _rows([tuple(x[c] for c in columns) for x in df.collect()]) == _rows(expected)


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
