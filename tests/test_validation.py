"""Validation: the reference's unit facts plus edge cases."""

from pyspark.sql import functions as F

from ledgerflow.operators import validate as VA


def test_duplicates_missing_and_drop(spark):
    df = spark.createDataFrame([(1, None), (1, 0.0), (2, 1.0)], "a long, b double")
    assert VA.check_duplicates(df).first()[0] == 1
    miss = {r["column"]: r["missing"] for r in VA.check_missing(df).collect()}
    assert miss["b"] == 1
    assert VA.drop_duplicates(df).count() == 3


def test_types(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, y string")
    t = VA.check_types(df)
    assert t["x"] in ("bigint", "int") and t["y"] == "string"


def test_outliers_flag_the_extreme(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (1000.0,)], "x double")
    assert VA.outliers_iqr(df, ["x"], 1.5).where("outlier_x").count() >= 1
    assert VA.outliers_zscore(df, ["x"], 2.0).where("outlier_x").count() >= 1


def test_zscore_zero_std_and_null(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert VA.outliers_zscore(df, ["x"]).where("outlier_x").count() == 0
    assert VA.outliers_iqr(df, ["x"]).where(F.col("outlier_x").isNull()).count() == 0


def test_drop_duplicates_subset_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "z"), (1, 2, "b")], "k int, t int, v string")
    out = {r.k: r.v for r in VA.drop_duplicates(df, ["k"], ["t"]).collect()}
    assert out == {1: "a", 2: "z"}


def test_worst_column_duplicates_ignore_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 1), (3, 2)], "a int, b int")
    assert VA.check_duplicates(df).first()[0] == 2
