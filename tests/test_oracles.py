"""Every registered query against its DuckDB oracle (order-insensitive)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from capture_lake.plans.queries import REGISTRY
from capture_lake.sources.testdata import TABLES
from conftest import SF_SMALL

ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in REGISTRY}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "file_hash"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows) == digest(ocols, orows)


@pytest.mark.parametrize("name", ["capture_records", "dedup_batch_first", "dedup_persistent", "batch_outcome"])
def test_shuffle_heavy_queries_without_aqe(spark, con, name):
    # correctness must not depend on runtime re-planning (AQE off, many partitions)
    df = E.queries()[name](spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert digest(df.columns, rows) == digest(ocols, cur.fetchall())
