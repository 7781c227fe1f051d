"""Sources and sinks: CSV, SQL text, JSON roots, flattening, page assembly."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path
from ledgerflow.sources import files as SF
from ledgerflow.sources import json_docs as SJ
from ledgerflow.sources.sql import read_sql_source


def test_csv_roundtrip_shape(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    path = SF.write_csv(df, scratch_path(spark, "csv2x2"))
    back = SF.read_csv(spark, path)
    assert back.count() == 2 and len(back.columns) == 2
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2), (3, 4)]


def test_csv_missing_raises(spark):
    with pytest.raises(FileNotFoundError):
        SF.read_csv(spark, scratch_path(spark, "nope"))


def test_sql_source_blank_and_bad(spark):
    df, q = read_sql_source(spark, {"query": "  "})
    assert df.columns == [] and q == ""
    df, q = read_sql_source(spark, {"query": "SELECT * FROM table_that_does_not_exist"})
    assert df.columns == [] and "table_that_does_not_exist" in q
    df, _ = read_sql_source(spark, {"query": "SELECT 1 AS x"})
    assert df.first().x == 1


def _docs(spark, *docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, doc string")


def test_json_root_shapes(spark):
    docs = _docs(spark,
                 '{"data": [{"k": 1}, {"k": 2}]}',                 # list at root path
                 '{"data": {"total": 3, "items": [{"k": 3}]}}',    # object: first list member
                 '{"data": {"k": 4}}',                             # object without list: one row
                 '{"other": [{"k": 5}]}')                          # path missing: whole doc -> its list
    rows = SJ.extract_root_rows(docs, "doc", "data", "k long", keep=["id"]).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.k) for r in rows] == [(0, 0, 1), (0, 1, 2), (1, 0, 3), (2, 0, 4), (3, 0, 5)]


def test_json_nested_root_path(spark):
    docs = _docs(spark, '{"a": {"b": [{"k": 7}]}}')
    assert SJ.extract_root_rows(docs, "doc", "a.b", "k long").first().k == 7


def test_flatten(spark):
    df = spark.createDataFrame([(1, (2, (3, [4])))], "id int, s struct<a:int, t:struct<b:int, l:array<int>>>")
    out = SJ.flatten(df)
    assert out.columns == ["id", "s.a", "s.t.b", "s.t.l"]
    assert out.first()["s.t.l"] == [4]


def _pages(spark, sizes, total=None):
    rows = []
    for p, n in enumerate(sizes):
        items = ",".join('{"v": %d}' % (p * 100 + i) for i in range(n))
        tot = f', "total": {total}' if total is not None else ""
        rows.append(("e", p, '{"data": [%s]%s}' % (items, tot)))
    return spark.createDataFrame(rows, "ep string, page int, doc string")


def test_pages_stop_on_short_page(spark):
    out = SJ.assemble_pages(_pages(spark, [3, 3, 2, 3]), "doc", "page", "v int", root="data",
                            key_cols=["ep"], limit=3, max_pages=100)
    assert sorted(r.page for r in out.select("page").distinct().collect()) == [0, 1, 2]


def test_pages_stop_on_total_and_max_pages(spark):
    out = SJ.assemble_pages(_pages(spark, [3, 3, 3, 3], total=6), "doc", "page", "v int", root="data",
                            key_cols=["ep"], limit=3, max_pages=100, total_path="total")
    assert out.count() == 6
    out = SJ.assemble_pages(_pages(spark, [3, 3, 3, 3]), "doc", "page", "v int", root="data",
                            limit=3, max_pages=2)
    assert out.count() == 6


def test_parquet_sink_roundtrip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, s string")
    back = SF.read_parquet(spark, SF.save_parquet(df, scratch_path(spark, "pq"), partition_by=["s"]))
    assert sorted((r.x, r.s) for r in back.collect()) == [(1, "a"), (2, None)]


def test_metrics_kv(spark):
    from ledgerflow.sources.tables import metrics_to_kv
    m = spark.createDataFrame([(3, 1.5)], "n long, avg double")
    kv = {r.metric: r.value for r in metrics_to_kv(m).collect()}
    assert kv == {"n": "3", "avg": "1.5"}
    assert F is not None


def test_csv_corrupt_rows_kept(spark):
    path = scratch_path(spark, "bad_csv")
    spark.createDataFrame([("1", "2.5"), ("x", "3.0")], "a string, b string").write.option("header", "true").csv(path)
    df = SF.read_csv(spark, path, "a INT, b DOUBLE", corrupt_column="_bad")
    rows = sorted(df.collect(), key=lambda r: (r.a is None, r.a))
    assert rows[0].a == 1 and rows[0]._bad is None
    assert rows[1].a is None and rows[1]._bad == "x,3.0"


def test_json_malformed_and_empty_lists(spark):
    docs = _docs(spark, '{"data": [}', '{"data": []}', 'not json at all', '{"data": [{"k": 9}]}')
    rows = SJ.extract_root_rows(docs, "doc", "data", "k long", keep=["id"]).collect()
    assert [(r.id, r.k) for r in rows] == [(3, 9)]


def test_bucketed_tables_join_without_shuffle(spark):
    from ledgerflow.sources.tables import save_table
    a = spark.range(2000).selectExpr("id % 97 AS customer_id", "id AS order_id")
    b = spark.range(97).selectExpr("id AS customer_id", "CAST(id AS STRING) AS country")
    save_table(a, "t_orders_b", "replace", bucket_by=(8, ["customer_id"]), path=scratch_path(spark, "ob"))
    save_table(b, "t_cust_b", "replace", bucket_by=(8, ["customer_id"]), path=scratch_path(spark, "cb"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_orders_b").join(spark.table("t_cust_b"), "customer_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_jdbc_options_of_dsn_and_partition():
    from ledgerflow.sources.sql import jdbc_options
    one = jdbc_options("select 1", dsn="postgresql+psycopg2://u:p%40w@db:5432/shop")
    assert one == {"url": "jdbc:postgresql://db:5432/shop", "user": "u", "password": "p@w", "query": "select 1"}
    many = jdbc_options("select * from t;", {"user": "x"}, "jdbc:mysql://h/d",
                        {"column": "id", "lower": 1, "upper": 10, "num": 4})
    assert many == {"url": "jdbc:mysql://h/d", "user": "x", "dbtable": "(select * from t) q", "partitionColumn": "id",
                    "lowerBound": "1", "upperBound": "10", "numPartitions": "4"}
