"""Every registered query runs; those with SQL agree with DuckDB."""

import os

import pytest

from prospectra.catalog import load
from prospectra.catalog.world import TABLES

SF = "/root/testdata/sf0.001"
ENTRIES = load()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple((type(r[i]).__name__, r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, duck, name):
    item = ENTRIES[name]
    df = item.run(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if item.sql is None:
        assert df.columns
        return
    answer = duck.execute(item.sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(rows, df.columns) == canonical(answer.fetchall(), columns)


def test_every_query_names_what_it_covers():
    assert all(e.covers for e in ENTRIES.values())
