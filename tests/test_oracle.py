"""Every query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from pulsegrid.plans.queries import ORACLE_SQL, QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows, names):
    at = sorted(range(len(names)), key=lambda k: names[k])
    show = lambda v: f"{v:.7g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[k]) for k in at) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    r = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(df.columns)
    assert got == plain(r.fetchall(), names)


def test_components_partition_the_nodes(spark):
    df = QUERIES["l8_components"](spark, SF)
    assert df.count() == df.select("node").distinct().count()
