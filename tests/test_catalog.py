"""The registered queries as a whole; ``check.py`` compares them with SQL one by one."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tabulon.catalog import CATALOG

FOLDER = entry.SMOKE_FOLDER
def test_every_query_has_sql():
    assert not [name for name, e in CATALOG.items() if e.sql is None]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
@pytest.mark.parametrize("name", ["flag_outliers", "describe_numeric", "split_rows", "roc_auc", "stream_ingest"])
def test_columns_and_sizes_match_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    got = entry.queries()[name](spark, FOLDER)
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and got.count() == len(want)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
def test_entry(spark):
    assert entry.entry(spark).columns[0] == "filename"
