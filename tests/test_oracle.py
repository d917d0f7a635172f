"""Every catalog query equals its independent SQL (DuckDB) on sf0.001."""
import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import catalog
from tessera.sources.tables import TEST_TABLES

# Queries outside the catalog have their own tests; some of them have no SQL.
NAMES = sorted(catalog.QUERIES)


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf001):
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)
    assert set(catalog.SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, sf001, name):
    df = entry.queries()[name](spark, sf001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region_key", "region_name", "sales", "units", "revenue"]
    assert df.count() == 6


def test_entry_schema_is_stable(spark):
    first = entry.entry(spark).schema
    assert entry.entry(spark).schema == first
