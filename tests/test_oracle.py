"""Registered queries against their DuckDB oracle on the sf0.001 tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from logsift.plans.catalog import QUERIES
from logsift.plans.oracle import ORACLE_SQL

TABLES = ("events", "nation", "region")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_requests == 1000


def test_every_query_has_oracle_or_is_model_based(spark):
    assert set(QUERIES) - set(ORACLE_SQL) == {"kmeans_clusters", "isolation_forest"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


KEYS = sorted(k for k in ORACLE_SQL if k not in ("stream_roundtrip",))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    res = duck.execute(ORACLE_SQL[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert canon(scols, srows) == canon(dcols, drows)
