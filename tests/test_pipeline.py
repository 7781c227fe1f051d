"""End-to-end run over small CSV sources (the reference's pipeline test, with real paths)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.plans.pipeline import run_pipeline
from ledgerflow.session import scratch_path
from ledgerflow.sources import files as SF


def test_pipeline_small_sources(spark):
    sales = spark.createDataFrame([(10, dt.date(2024, 1, 1)), (20, dt.date(2024, 1, 2))], "amount int, order_date date")
    cust = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "id int, is_vip int")
    sp = SF.write_csv(sales.withColumn("order_id", F.lit(1)), scratch_path(spark, "mini_sales"))
    cp = SF.write_csv(cust, scratch_path(spark, "mini_customers"))
    cfg = {"sources": {"csv": [{"name": "sales", "path": sp}, {"name": "customers", "path": cp}]},
           "ml": {"enabled": True, "regression": {"n_estimators": 5}},
           "paths": {"models": scratch_path(spark, "models")}}
    res = run_pipeline(spark, cfg)
    s = res["summary"].first()
    assert s.rows_raw == 5 and s.n_sources == 1 and s.date_min == dt.date(2024, 1, 1)
    assert "sales_duplicates" in res["cleaning_stats"].columns
    assert res["tables"]["monthly_revenue"].count() == 1
    assert isinstance(res["ml"]["metrics"], dict)            # a failing model task is logged, not raised


def test_pipeline_defaults_when_nothing_routes(spark):
    sales = spark.createDataFrame([(1, 5.0)], "order_id long, amount double")
    dp = SF.write_csv(sales, scratch_path(spark, "default_sales"))
    res = run_pipeline(spark, {"sources": {}, "default_paths": [dp]})
    assert res["summary"].first().rows_raw == 1
