"""Standard views over the test tables, in Spark and as DuckDB SQL text.

``sales``       one row per order (order_id, customer_id, order_date, amount, source)
``customers``   customer_id -> country (customer joined to nation)
``sales_dirty`` sales with deterministic nulls injected in amount / order_date / source,
                a mostly-empty ``country`` column, and an exact copy of every tenth order
                appended (so duplicate counting has real duplicates).  The modulo rules
                only decide *where* faults are injected; every order is kept.

The DuckDB text below states the same definitions so the oracle can inline them as CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The order status -> source-kind mapping used to build the sales view.
STATUS_TO_SOURCE = {"F": "file", "O": "db"}  # any other status -> "api"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source_of(status: Column) -> Column:
    return (F.when(status == "F", F.lit("file"))
             .when(status == "O", F.lit("db"))
             .otherwise(F.lit("api")))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        _source_of(F.col("o_orderstatus")).alias("source"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension; the planner broadcasts it on its own
    # (size checked against autoBroadcastJoinThreshold from file statistics).
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country")))


def sales_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sales(spark, sf_dir)
    oid = F.col("order_id")
    base = s.select(
        "order_id", "customer_id",
        F.when(oid % 13 == 0, F.lit(None).cast("date")).otherwise(F.col("order_date")).alias("order_date"),
        F.when(oid % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("amount")).alias("amount"),
        F.when(oid % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("source"),
        F.when(oid % 10 != 0, F.lit(None).cast("string")).otherwise(F.lit("X")).alias("country"),
    )
    return base.unionByName(base.filter(oid % 10 == 0))


def sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sales with every column as text and junk in amount / order_date / ids
    (input for type coercion and date parsing)."""
    s = sales(spark, sf_dir)
    oid = F.col("order_id")
    return s.select(
        F.when(oid % 19 == 0, F.lit("n/a")).otherwise(oid.cast("string")).alias("order_id"),
        F.when(oid % 23 == 0, F.concat(F.col("customer_id").cast("string"), F.lit(".5")))
         .otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
        F.when(oid % 13 == 0, F.lit("not a date")).otherwise(F.col("order_date").cast("string")).alias("order_date"),
        F.when(oid % 7 == 0, F.lit("bad")).otherwise(F.col("amount").cast("string")).alias("amount"),
        "source",
    )


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register the base tables and the standard views as temp views."""
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "embeddings"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    sales(spark, sf_dir).createOrReplaceTempView("sales")
    customers(spark, sf_dir).createOrReplaceTempView("customers")
    sales_dirty(spark, sf_dir).createOrReplaceTempView("sales_dirty")


# ---------------------------------------------------------------------------
# DuckDB text of the same views (used only by the oracle SQL).
# ---------------------------------------------------------------------------
SQL_SALES = """sales AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_totalprice AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'file' WHEN 'O' THEN 'db' ELSE 'api' END AS source
  FROM orders)"""

SQL_CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

SQL_SALES_DIRTY = """sales_dirty0 AS (
  SELECT order_id, customer_id,
         CASE WHEN order_id % 13 = 0 THEN NULL ELSE order_date END AS order_date,
         CASE WHEN order_id % 11 = 0 THEN NULL ELSE amount END AS amount,
         CASE WHEN order_id % 17 = 0 THEN NULL ELSE source END AS source,
         CASE WHEN order_id % 10 <> 0 THEN NULL ELSE 'X' END AS country
  FROM sales),
sales_dirty AS (
  SELECT * FROM sales_dirty0 UNION ALL SELECT * FROM sales_dirty0 WHERE order_id % 10 = 0)"""

SQL_SALES_TEXT = """sales_text AS (
  SELECT CASE WHEN order_id % 19 = 0 THEN 'n/a' ELSE CAST(order_id AS VARCHAR) END AS order_id,
         CASE WHEN order_id % 23 = 0 THEN CAST(customer_id AS VARCHAR) || '.5'
              ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
         CASE WHEN order_id % 13 = 0 THEN 'not a date' ELSE CAST(order_date AS VARCHAR) END AS order_date,
         CASE WHEN order_id % 7 = 0 THEN 'bad' ELSE CAST(amount AS VARCHAR) END AS amount,
         source
  FROM sales)"""


def with_views(body: str, *, customers: bool = False, dirty: bool = False, text: bool = False) -> str:
    """Prefix an oracle query with the CTEs it needs."""
    ctes = [SQL_SALES]
    if customers:
        ctes.append(SQL_CUSTOMERS)
    if dirty:
        ctes.append(SQL_SALES_DIRTY)
    if text:
        ctes.append(SQL_SALES_TEXT)
    return "WITH " + ",\n".join(ctes) + "\n" + body
