"""Forests on counted cells, label codes without a shuffle of the rows, JSON parsed once per step."""

import io
from contextlib import redirect_stdout

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.operators import encode as EN
from ledgerflow.operators import forest as FO
from ledgerflow.operators import ml as ML
from ledgerflow.sources import json_docs as SJ


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(True)
    return out.getvalue().split("== Optimized Logical Plan ==")[1]


def test_bootstrap_weights_are_poisson_and_by_row():
    h = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 4000, np.int64)
    one = FO.bootstrap_weights(h, np.ones(4000, np.int64), 51)
    assert abs(one.mean() - 1) < 0.01 and abs(one.var() - 1) < 0.02
    assert abs((one == 0).mean() - np.exp(-1)) < 0.005
    assert abs(np.corrcoef(one[:, 0], one[:, 1])[0, 1]) < 0.06
    for m in (5, 40):
        many = FO.bootstrap_weights(h, np.full(4000, m), 51)
        assert abs(many.mean() / m - 1) < 0.01 and abs(many.var() / m - 1) < 0.03
    assert (FO.bootstrap_weights(h[::-1], np.ones(4000, np.int64), 51)[::-1] == one).all()


def test_forest_agrees_under_any_partitioning(spark):
    x = spark.range(600).select((F.col("id") % 13).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                (F.col("id") % 13 * 3 + F.col("id") % 5).cast("double").alias("t"))
    got = []
    for n in (1, 5):
        model = ML.train_forest(x.repartition(n), ["a", "b"], "t", num_trees=12, max_depth=6)
        got.append(sorted((r.a, r.b, round(r.prediction, 9)) for r in ML.predict_forest(model, x, ["a", "b"]).distinct().collect()))
    assert got[0] == got[1]


def test_one_tree_is_the_best_one(spark):
    """A step in one feature and a smaller one in another: splits, leaves and importances are known."""
    x = spark.range(4000).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 4).cast("double").alias("b"))
    x = x.withColumn("t", F.when(F.col("a") > 6, 100.0).otherwise(0.0) + F.when(F.col("b") > 1, 1.0).otherwise(0.0))
    model = ML.train_forest(x, ["a", "b"], "t", num_trees=3, max_depth=2)
    pred = ML.predict_forest(model, x, ["a", "b"])
    assert pred.columns == ["t", "a", "b", "prediction"] and pred.count() == 4000
    assert pred.where(F.abs(F.col("t") - F.col("prediction")) > 1e-9).count() == 0
    imp = {r.feature: r.importance for r in ML.forest_importances(model, ["a", "b"]).collect()}
    assert imp["a"] > 0.999 and 0 < imp["b"] < 0.001


def test_forest_saved_and_read_back(spark, tmp_path):
    x = spark.range(300).select(F.col("id").cast("double").alias("a"), (F.col("id") * F.col("id")).cast("double").alias("t"))
    model = ML.train_forest(x, ["a"], "t", num_trees=5, max_depth=4)
    again = ML.load_model(ML.save_model(model, str(tmp_path / "m")))
    score = lambda m: sorted((r.a, r.prediction) for r in ML.predict_forest(m, x, ["a"]).collect())
    assert score(model) == score(again)


def test_label_codes_leave_the_rows_where_they_are(spark):
    x = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4)], "c string, id int")
    got = EN.label_encode(x)
    assert sorted((r.id, r.c) for r in got.collect()) == [(1, 1), (2, 0), (3, -1), (4, 1)]
    assert "BroadcastHashJoin" in _plan(got) and "SortMergeJoin" not in _plan(got)


def test_json_documents_are_parsed_once_per_step(spark):
    docs = [(1, '{"r": {"n": 2, "items": [{"k": 1}, {"k": 2}], "more": [{"k": 9}]}}'), (2, '{"r": [{"k": 3}]}'), (3, '{"r": {"k": 4}}'),
            (4, '{"r": {"k": 5, "none": []}}'), (5, '{"k": 6}'), (6, "junk"), (7, None), (8, '{"r": null}')]
    df = spark.createDataFrame(docs, "id int, doc string")
    got = SJ.extract_root_rows(df, "doc", "r", "k BIGINT", keep=["id"])
    assert sorted((r.id, r.pos, r.k) for r in got.collect()) == [(1, 0, 1), (1, 1, 2), (2, 0, 3), (3, 0, 4), (4, 0, 5), (5, 0, 6)]
    optimized = _plan(got).split("== Physical Plan ==")[0]
    assert optimized.count("get_json_object(") <= 4 and optimized.count("json_object_keys(") <= 2
