"""Every query against its DuckDB text on the smallest tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from gridsight.operators import mining
from gridsight.plans import catalog, reviews
from gridsight.plans.fixtures import Tables


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    return round(value, 9) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def con(small):
    found = duckdb.connect()
    for name in os.listdir(small):
        found.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{small}/{name}'")
    return found


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_against_sql(spark, small, con, name):
    got = catalog.QUERIES[name](spark, small)
    want = con.sql(catalog.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert sorted(repr([_plain(r[c]) for c in columns]) for r in got.collect()) == sorted(repr([_plain(r[k]) for k in order]) for r in want.fetchall())


def test_mining_counts_every_detection(spark, small):
    t = Tables(spark, small)
    cells = {r["name"]: r for r in reviews._mining_cells(t).collect()}
    count = Counter(f"mine-{int(r['cx'] // 300)}-{int(r['cy'] // 300)}" for r in t.boxes().select("cx", "cy").collect())
    assert {k: r["n"] for k, r in cells.items() if r["n"]} == count
    assert all(r["n"] == 0 for k, r in cells.items() if k not in count)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1000
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
