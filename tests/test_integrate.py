"""Routing, tagging, union by name, positional concat, multi-source load."""

from ledgerflow.operators import integrate as I
from ledgerflow.session import scratch_path
from ledgerflow.sources import files as SF


def test_classify_target():
    assert I.classify_target("x", [], "Users") == "users"
    assert I.classify_target("Orders", ["a"]) == "sales"
    assert I.classify_target("clients", []) == "customers"
    assert I.classify_target("t", ["order_id", "AMOUNT"]) == "sales"
    assert I.classify_target("t", ["customer_id", "country"]) == "customers"
    assert I.classify_target("t", ["id", "firstName", "email"]) == "users"
    assert I.classify_target("t", ["id", "title", "price"]) == "products"
    assert I.classify_target("t", ["q"]) is None


def test_add_source_fills_only_nulls(spark):
    df = spark.createDataFrame([(1, "api"), (2, None)], "x int, source string")
    assert [r.source for r in I.add_source(df, "db").orderBy("x").collect()] == ["api", "db"]
    assert I.add_source(df.drop("source"), "file").first().source == "file"


def test_union_by_name_with_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "order_id long, amount double")
    b = spark.createDataFrame([(7, "FR")], "customer_id long, country string")
    u = I.union_sources([a, b])
    assert u.columns == ["order_id", "amount", "customer_id", "country"]
    assert u.count() == 2 and u.where("country IS NULL").count() == 1


def test_project_keep(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert I.project_keep(df, ["b", "zz"]).columns == ["b"]
    assert I.project_keep(df, ["zz"]).columns == ["a", "b"]
    assert I.project_keep(df, None).columns == ["a", "b"]


def test_concat_columns_pads_and_prefixes(spark):
    s = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 3.0)], "id long, amount double")
    u = spark.createDataFrame([(9, "x")], "id long, name string")
    out = I.concat_columns({"sales": s, "users": u}, {"sales": ["id"], "users": ["id"]}).orderBy("row_idx")
    rows = out.collect()
    assert out.columns == ["row_idx", "id", "amount", "users.id", "name"]
    assert [r.id for r in rows] == [1, 2, 3]
    assert rows[0]["users.id"] == 9 and rows[1]["users.id"] is None


def test_load_sources_routes_and_skips(spark):
    sales = spark.createDataFrame([(1, 10, 5.0), (2, 11, 6.0)], "order_id long, customer_id long, amount double")
    cust = spark.createDataFrame([(10, "FR")], "customer_id long, country string")
    sales.createOrReplaceTempView("t_sales")
    path = SF.write_csv(cust, scratch_path(spark, "cust"))
    users = spark.createDataFrame([(1, "A", "a@x")], "id long, firstName string, email string")
    upath = SF.write_csv(users, scratch_path(spark, "users"))
    cfg = {"sources": {
        "sql": [{"name": "anything", "query": "SELECT * FROM t_sales"}, {"name": "bad", "query": "SELECT * FROM nope"}],
        "csv": [{"name": "c", "path": path}, {"name": "u", "path": upath},
                {"name": "gone", "path": scratch_path(spark, "gone")}],
        "json": [{"name": "sales_api", "docs": spark.createDataFrame([('{"data":[{"order_id":3}]}',)], "doc string"),
                  "json_root": "data", "item_schema": "order_id long"}],
    }}
    s, u, p = I.load_sources(spark, cfg)
    assert sorted((r.source, r.order_id) for r in s.select("source", "order_id").collect()) == \
        [("api", 3), ("db", 1), ("db", 2), ("file", None)]
    assert u.count() == 1 and u.first().source == "file" and p is None
