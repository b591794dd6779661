"""Every catalog query against its DuckDB SQL on the smallest test folder:
same columns, same row count, same order-insensitive value hash."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import TABLES, digest
from shelfline.plans import catalog, catalog_storage, sql_oracle
from tests.conftest import SF001

CATALOG = catalog.QUERIES | catalog_storage.QUERIES
CATALOG_SQL = sql_oracle.SQL | catalog_storage.SQL
NAMES = sorted(CATALOG)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _check(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_sql():
    assert set(CATALOG) == set(CATALOG_SQL)
    assert set(CATALOG) <= set(entry.queries()) and set(CATALOG_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    _check(spark, duck, name)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "month_year" in df.columns
