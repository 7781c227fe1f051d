"""Inputs that used to lose rows or change values: NULL keys, mixed types, large ids, quoted CSV, odd JSON, text dates."""

import pytest
from pyspark.sql import functions as F

from ledgerflow import registry
from ledgerflow.operators import clean as C
from ledgerflow.operators import encode as EN
from ledgerflow.operators import features as FE
from ledgerflow.operators import integrate as I
from ledgerflow.operators import ml as ML
from ledgerflow.operators import profile as P
from ledgerflow.operators import report as R
from ledgerflow.plans.pipeline import run_pipeline
from ledgerflow.sources import files as SF
from ledgerflow.sources import json_docs as SJ


@pytest.fixture(scope="module")
def stack(spark):
    """4,400 rows like a stacked load: 200 of them without order id."""
    return spark.range(4400).select(
        F.when(F.col("id") >= 200, F.col("id")).alias("order_id"), (F.col("id") % 97).alias("customer_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7.0).alias("amount"), F.to_date(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))).alias("order_date"),
        F.lit("csv").alias("source"))


def test_splits_keep_every_row(stack):
    for part in (FE.split(stack, "order_id"), FE.split(stack, None), FE.split_stratified(stack.withColumn("y", F.col("amount") > 100), "y", "order_id")):
        n = {r["is_test"]: r["count"] for r in part.groupBy("is_test").count().collect()}
        assert set(n) == {True, False} and sum(n.values()) == 4400
    nulls = FE.split(stack, "order_id").where("order_id is null")
    assert nulls.select("is_test").distinct().count() == 2


def test_ml_uses_all_rows_and_reports_auc(stack):
    feats = FE.build_features(FE.split(stack, "order_id"))
    res = ML.run_ml(feats, {"ml": {"enabled": True, "regression": {"n_estimators": 5, "max_depth": 4}}})
    c, r = res["metrics"]["classification"].first(), res["metrics"]["regression"].first()
    assert c.n_train + c.n_test == 4400 and r.n_train + r.n_test == 4400 and 0 <= c.roc_auc <= 1


def test_failed_task_is_no_result(spark, stack, monkeypatch):
    def broken(*_, **__):
        raise OSError("no space left")

    feats = FE.build_features(FE.split(stack, "order_id"))
    with pytest.raises(ML.TasksFailed, match="no column 'price'"):
        ML.run_ml(feats, {"ml": {"classification": {"enabled": False}, "regression": {"target": "price"}}})
    monkeypatch.setattr(ML, "train_forest", broken)
    monkeypatch.setattr(registry, "_ml_features", lambda spark, sf: feats)
    with pytest.raises(ML.TasksFailed, match="regression failed: OSError: no space left") as e:
        registry.QUERIES["ml_stage_metrics"](spark, "")
    assert isinstance(e.value.__cause__, OSError) and list(e.value.result["failed"]) == ["regression"]
    assert e.value.result["metrics"]["classification"].first().n_test > 0           # the other task ran


def test_pipeline_names_failed_tasks(spark, stack, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise OSError("no space left")

    monkeypatch.setattr(ML, "train_logreg", broken)
    monkeypatch.setattr(ML, "train_forest", broken)
    stack.drop("source").write.csv(str(tmp_path / "s"), header=True)
    cfg = {"sources": {"csv": [{"name": "sales", "path": str(tmp_path / "s")}]}, "ml": {"enabled": True}}
    res = run_pipeline(spark, cfg)
    assert {r.task: r.error for r in res["tables"]["ml_failed"].collect()} == dict.fromkeys(("classification", "regression"), "OSError: no space left")
    assert res["ml"]["metrics"] == {} and res["summary"].first().rows_raw == 4400


def test_mixed_types_stack(spark):
    a = spark.sql("select 1 as order_id, date'2024-01-02' as order_date, 2.5D as amount")
    b = spark.sql("select 9007199254740993 as order_id, 'bad' as order_date, 'x' as amount")
    out = C.coerce_types(I.union_sources([a, b])).orderBy("order_id").collect()
    assert [r.order_id for r in out] == [1, 9007199254740993] and [r.amount for r in out] == [2.5, None]
    assert str(out[0].order_date)[:10] == "2024-01-02" and out[1].order_date is None


def test_csv_with_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n"x ""y"" z",1\n"two\nlines",2\n')
    rows = SF.read_csv(spark, str(tmp_path / "q.csv"), "a string, b int", multiLine=True).collect()
    assert [(r.a, r.b) for r in rows] == [('x "y" z', 1), ("two\nlines", 2)]


def test_json_null_root_and_empty_list(spark):
    df = spark.createDataFrame([('{"data": null, "other": [{"k": 1}]}',), ('{"data": [{"k": 2}]}',), ('{"other": [{"k": 3}]}',), ('{"k": 4, "data": {"l": [], "k": 5}}',)], "doc string")
    assert sorted(r.k for r in SJ.extract_root_rows(df, "doc", "data", "k int").collect()) == [2, 3, 5]


def test_pages_counted_not_numbered(spark):
    df = spark.createDataFrame([(p, '[{"k": 1}, {"k": 2}]') for p in range(1, 8)], "page long, doc string")
    got = SJ.assemble_pages(df, "doc", "page", "k int", limit=2, max_pages=5)
    assert sorted({r.page for r in got.collect()}) == [1, 2, 3, 4, 5]
    assert SJ.assemble_pages(df, "doc", "page", "k int", limit=2, max_pages=None).count() == 14


def test_text_dates_and_whiskers(spark):
    df = spark.createDataFrame([("2024/03/01", 1.0), ("2024-03-01T10:00:00Z", 2.0), ("nonsense", 3.0), (None, 1000.0)], "d string, x double")
    assert [(str(r.day), r.orders) for r in R.orders_per_day(df, "d").collect()] == [("2024-03-01", 2)]
    assert str(P.date_range(df, "d").first().date_min) == "2024-03-01"
    b = R.box_stats(df, "x", by=None).first()
    assert b.whisker_hi >= b.q3 and b.whisker_lo <= b.q1


def test_dotted_names(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "`address.city` string")
    assert sorted(r[0] for r in EN.label_encode(df).collect()) == [-1, 0, 1]
