"""Queries with SQL against DuckDB, and the names the entry module lists."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from ledgerflow.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, cur.fetchall()))


def test_entry_lists_all():
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in registry.QUERIES if k != "pipeline"}
    assert set(registry.QUERIES) <= set(E.queries()) and len(corpus_pipeline.STAGES) == 5


def test_pipeline_keeps_columns_and_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if k < 3:
            assert 0.7 * n < docs.count() <= n
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(ids) == docs.count() and sorted(r.start for r in ids)[0] == 0
