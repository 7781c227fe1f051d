"""Every registered query against its DuckDB oracle at sf0.001 (rows-only keys:
row count > 0).  This is the same comparison the round driver runs at sf0.01."""

import collections
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from ledgerflow import registry

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
SLOW = {"logreg_train", "logreg_coeffs", "rf_train", "rf_plain", "rf_importance", "model_roundtrip",
        "ml_stage_metrics", "logreg_plain"}


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(k for k in registry.QUERIES if k not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = duck.sql(sql)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dtypes
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert _canon(cols, rows) == _canon(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "source", "revenue"] and df.count() > 0
