"""Every query with SQL against DuckDB on the smallest tables; the others for their shape."""

import collections
import math

import duckdb
import pytest

from tessera import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    try:
        y = float(x)
    except (TypeError, ValueError):
        return x
    return None if math.isnan(y) else y + 0.0


@pytest.mark.parametrize("name", sorted(catalog.SQL_NAMES))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    got = collections.Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert got == collections.Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry_has_all_queries():
    import __spark_entry__ as e

    assert set(catalog.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
