"""Cleaning counted while it is written; joins and history on stored tables."""

import datetime as dt
import re

from pyspark.sql import functions as F

from ledgerflow.operators import colocated as CO
from ledgerflow.operators.clean import run_cleaning
from ledgerflow.operators.features import history_features
from ledgerflow.operators.profile import overall_metrics
from ledgerflow.plans.cleaned_store import clean_to_parquet
from ledgerflow.session import scratch_path

SALES = "order_id long, customer_id long, order_date date, amount double, source string"


def as_rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_one_pass_counts_like_the_scans(spark):
    rows = [(i, None if i % 5 == 0 else i % 7, f"2024-01-{1 + i % 28:02d}" if i % 3 else "no date", None if i % 4 == 0 else float("nan") if i % 9 == 0 else i / 3,
             "x" if i % 10 == 0 else None) for i in range(200)] * 2
    df = spark.createDataFrame(rows, "order_id long, customer_id long, order_date string, amount double, `odd name` string")
    got, want = clean_to_parquet(df, scratch_path(spark, "c")), run_cleaning(df)
    assert got.dropped == want.dropped == ["odd name"] and got.df.columns == want.df.columns
    assert as_rows(got.stats) == as_rows(want.stats) and as_rows(got.df) == as_rows(want.df)
    a, b = got.overall.first(), overall_metrics(df, want.df).first()
    assert a.asDict() == {**b.asDict(), "total_revenue_clean": a.total_revenue_clean, "avg_order_amount_clean": a.avg_order_amount_clean}
    assert abs(a.total_revenue_clean - b.total_revenue_clean) < 1e-6 and abs(a.avg_order_amount_clean - b.avg_order_amount_clean) < 1e-9


def test_the_input_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.col("id").alias("order_id"), (F.col("id") % 3).alias("customer_id"), F.lit(2.0).alias("amount"))
    stored = clean_to_parquet(df.mapInArrow(count, df.schema), scratch_path(spark, "c"))
    assert stored.rows == 1000 and stored.missing["amount"] == 0 and stored.stats.first()[0] == 0 and stored.df.count() == 1000
    assert seen.value == 1000


def test_empty_and_dropped_amounts(spark):
    none = clean_to_parquet(spark.createDataFrame([], SALES), scratch_path(spark, "c"), partition_by=["source"])
    assert none.rows == 0 and none.dropped == [] and none.stats.first()[0] == 0 and none.overall.first().total_revenue_clean == 0.0
    gone = clean_to_parquet(spark.createDataFrame([(1, 1, None, None, "a")] * 3, SALES), scratch_path(spark, "c"))
    assert gone.dropped == ["order_date", "amount"] and gone.overall.first().total_revenue_clean is None and gone.stats.first()[0] == 2


def skewed(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i * 7 % 50) if i % 11 else None
    rows = [(i, 1 if i % 3 == 0 else None if i % 17 == 0 else i % 40, day(i), float(i % 9) if i % 6 else None, "s") for i in range(900)]
    rows += rows[:60] + [(5000, 2, day(1), 1.0, "s")] * 150
    return spark.createDataFrame(rows, SALES)


def store(spark, df, buckets=8):
    folder = scratch_path(spark, "stored")
    tag = folder[-6:]
    fact = CO.store_by_key(df, f"fact_{tag}", "customer_id", ["order_date", "order_id", "source"], buckets, folder)
    people = spark.createDataFrame([(k, f"c{k % 5}") for k in range(45)] + [(1, "again"), (None, "nobody")], "customer_id long, country string")
    return fact, people, CO.store_dimension(people, f"people_{tag}", "customer_id", buckets, folder)


def test_stored_rows_join_and_run_like_loose_ones(spark):
    df = skewed(spark)
    fact, people, dim = store(spark, df)
    assert as_rows(CO.join_stored(spark, fact, dim, ["country"])) == as_rows(df.join(people, "customer_id").select(*df.columns, "country"))
    got, want = CO.stored_history(spark, fact), history_features(df)
    assert got.columns == want.columns
    near = lambda d: as_rows(d.withColumn("_amount_prev_mean", F.round("_amount_prev_mean", 9)))
    assert near(got) == near(want)
    assert spark.table(fact.hot).select("customer_id").distinct().count() == 3           # 1, 2 and null
    empty, _, d0 = store(spark, df.limit(0))
    assert CO.stored_history(spark, empty).count() == 0 and CO.join_stored(spark, empty, d0, ["country"]).count() == 0


def test_no_row_of_the_stored_table_is_shuffled(spark):
    fact, _, dim = store(spark, skewed(spark))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")                         # also without a small dimension
    try:
        for df in (CO.join_stored(spark, fact, dim, ["country"]), CO.stored_history(spark, fact)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"(?<!Broadcast)Exchange (hash|range|round|Single)", plan), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_rows_are_spread_over_slices(spark):
    fact, *_ = store(spark, skewed(spark))
    sizes = [r["count"] for r in spark.table(fact.hot).where("customer_id = 1").groupBy(CO.SLICE).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < sum(sizes) / 2


def test_models_still_run_after_an_observed_write(spark):
    from ledgerflow.operators import ml

    df = spark.createDataFrame([(float(i % 7), i % 2) for i in range(60)], "x double, y int")
    clean_to_parquet(df, scratch_path(spark, "c"))
    assert ml.roc_auc(ml.score_logreg(ml.train_logreg(df, ["x"], "y"), df, ["x"]), "y").count() == 1


def test_a_repeated_export_doubles_nothing(spark):
    from ledgerflow.sources.tables import export_metrics, export_metrics_run

    sales = spark.createDataFrame([(i, i % 4, dt.date(2024, 1, 1), 1.0, "s") for i in range(9)], SALES)
    people = spark.createDataFrame([(k, f"c{k % 2}") for k in range(4)], "customer_id long, country string")
    path = scratch_path(spark, "metrics")
    export_metrics_run(sales, people, path, "a")
    export_metrics_run(sales.limit(0), people, path, "b")
    got = export_metrics_run(sales, people, path, "a")
    want = [(r.metric, r.value) for r in export_metrics(sales, people).collect()]
    assert sorted((r.metric, r.value) for r in got.where("run_id = 'a'").collect()) == sorted(want)
    assert {r.metric: r.value for r in got.where("run_id = 'b'").collect()} == {"sales_count": "0", "customers_count": "4"}
