"""Cleaning and coercion: the reference's unit facts plus edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import clean as C
from ledgerflow.operators import encode as EN


@pytest.fixture()
def clean_small(spark):
    return spark.createDataFrame([(1.0, "a", "2024-01-01"), (None, "b", "2024-01-02"), (3.0, "a", None)],
                                 "num double, cat string, date string")


def test_reference_cleaner_chain(spark, clean_small):
    imp = C.impute(clean_small, "median")
    assert imp.where(F.col("num").isNull()).count() == 0
    assert imp.where(F.col("cat") == "b").select("num").first()[0] == 2.0
    enc = EN.one_hot(imp)
    assert any(c.startswith("cat_") for c in enc.columns)
    assert "date" in enc.columns                       # names with "date" are not encoded
    sc = C.scale(enc, "standard")
    assert abs(sc.agg(F.avg("num")).first()[0]) < 1e-9
    pd_ = C.parse_dates(sc, ["date"])
    assert isinstance(pd_.schema["date"].dataType, T.TimestampNTZType)


def test_impute_mode_ties_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "s string, e string")
    out = C.impute(df).collect()
    assert [r.s for r in out] == ["b", "a", "a"]        # tie a/b -> smallest
    assert all(r.e == "" for r in out)                 # all-null text -> ""


def test_coerce_types_bad_values_become_null(spark):
    df = spark.createDataFrame([("1", "2.5", "2024-03-01", "10.5"), ("x", "7", "bad", "bad"),
                                ("3.0", "8", "2024-03-02T10:11:12", None)],
                               "order_id string, customer_id string, order_date string, amount string")
    rows = C.coerce_types(df).collect()
    assert rows[0].order_id == 1 and rows[0].customer_id is None and rows[0].amount == 10.5
    assert rows[0].order_date == dt.datetime(2024, 3, 1)
    assert rows[1].order_id is None and rows[1].order_date is None and rows[1].amount is None
    assert rows[2].order_id == 3 and rows[2].order_date == dt.datetime(2024, 3, 2, 10, 11, 12)


def test_drop_high_missing_is_strict(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1), (3, None, 1), (4, None, 1), (5, 1, 1)],
                               "a int, b int, c int")
    out, dropped = C.drop_high_missing(df, 0.8)
    assert dropped == []                               # b is exactly 0.8 missing -> kept
    out, dropped = C.drop_high_missing(df, 0.7)
    assert dropped == ["b"] and out.columns == ["a", "c"]


def test_run_cleaning_counts_but_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "2024-01-01", 5.0), (1, 1, "2024-01-01", 5.0), (2, None, None, None)],
                               "order_id long, customer_id long, order_date string, amount double")
    res = C.run_cleaning(df)
    st = res.stats.first()
    assert st.sales_duplicates == 1 and st.missing_customer_id == 1 and st.missing_amount == 1
    assert res.df.count() == 3


def test_scaling_constant_and_nulls(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, None), (5.0, 3.0)], "k double, x double")
    s = C.scale(df, "standard").collect()
    assert [r.k for r in s] == [0.0, 0.0, 0.0] and s[1].x is None
    m = C.scale(df, "minmax").collect()
    assert [r.k for r in m] == [0.0, 0.0, 0.0] and [m[0].x, m[2].x] == [0.0, 1.0]


def test_label_and_onehot_null_handling(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert [r.c for r in EN.label_encode(df).orderBy("c").collect()] == [-1, 0, 1]
    oh = EN.one_hot(df).collect()
    assert oh[2].c_a == 0.0 and oh[2].c_b == 0.0 and oh[0].c_b == 1.0


def test_smart_encode_bounds(spark):
    df = spark.createDataFrame([("x", "u1", "k"), ("y", "u2", "k"), ("x", "u3", "k")], "a string, b string, c string")
    out, cols = EN.smart_encode(df, {"max_onehot_unique": 2})
    assert cols == ["a"]                                # b has 3 values, c only 1
    assert out.schema["a_x"].dataType == T.BooleanType()


def test_list_to_json_sorted_keys(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2}, [1, 2])], "m map<string,int>, l array<int>")
    r = EN.list_to_json(df).first()
    assert r.m == '{"a":2,"b":1}' and r.l == "[1,2]"


def test_one_hot_category_cap(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "c string, d string")
    with pytest.raises(EN.TooManyCategories):
        EN.one_hot(df, max_categories=2)
    assert EN.distinct_values(df, ["c", "d"], 3) == {"c": ["a", "b", "c"], "d": ["x"]}
