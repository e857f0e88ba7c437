"""Every registered query against its oracle, over the smallest tables."""

import math

import duckdb
import pytest

from lexispark import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def plain(rows, columns):
    def cell(v):
        if v is None or isinstance(v, str):
            return v
        if isinstance(v, float) and math.isnan(v):
            return None
        return float(v)

    return sorted(([cell(r[c]) for c in sorted(columns)] for r in rows), key=repr)


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(spark, duck, small, name):
    df = catalog.QUERIES[name](spark, small)
    rows = [r.asDict() for r in df.collect()]
    if name not in catalog.ORACLES:
        assert rows
        return
    found = duck.sql(catalog.ORACLES[name])
    want = [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]
    assert sorted(df.columns) == sorted(found.columns)
    assert plain(rows, df.columns) == plain(want, found.columns)


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())
