"""Features against brute force (including a hot key and exact copies), and
model/metric properties."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerflow.functions.prefix import prefix_by_key
from ledgerflow.operators import features as FE
from ledgerflow.operators import ml as ML


def _orders(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cust = 1 if rnd.random() < 0.4 else rnd.choice([2, 3, 4, None])     # customer 1 is a hot key
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))
        amt = None if rnd.random() < 0.1 else float(rnd.randint(1, 500))
        rows.append((i, cust, day, amt, rnd.choice(["db", "file", None])))
    rows += rows[:30]                                                       # exact copies
    return spark.createDataFrame(rows, "order_id long, customer_id long, order_date date, amount double, source string")


def test_history_features_match_brute_force(spark):
    df = _orders(spark)
    got = FE.history_features(df).toPandas()
    pdf = df.toPandas()
    pdf["_src"] = pdf["source"].fillna("")
    pdf = pdf.sort_values(["customer_id", "order_date", "order_id", "_src"], na_position="first", kind="stable")
    exp = []
    for cust, g in pdf.groupby("customer_id", dropna=False, sort=False):
        amounts = []
        for k, (_, r) in enumerate(g.iterrows()):
            if pd.isna(cust):
                exp.append((r.order_id, 0, 0.0))
                continue
            nn = [a for a in amounts if not pd.isna(a)]
            exp.append((r.order_id, k, float(np.mean(nn)) if nn else 0.0))
            amounts.append(r.amount)
    got_l = sorted((int(a), int(b), round(c, 6))
                   for a, b, c in got[["order_id", "_cnt_prev", "_amount_prev_mean"]].itertuples(index=False))
    exp_l = sorted((int(a), int(b), round(c, 6)) for a, b, c in exp)
    assert got_l == exp_l


def test_prefix_splits_hot_key_across_partitions(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.lit(1.0).alias("v"))
    p = prefix_by_key(df, "k", ["t"], "v", partitions=8)
    assert sorted(r._prev_n for r in p.collect()) == list(range(2000))


def test_calendar_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),), (None,)], "order_date date")
    rows = FE.calendar_features(df).collect()
    assert [(r.dow, r.month, r.is_weekend) for r in rows] == [(0, 1, 0), (5, 1, 1), (0, 0, 0)]


def test_build_features_five_numeric_features(spark):
    x = FE.build_features(_orders(spark))
    feats = FE.numeric_feature_columns(x, drop=["amount"])
    assert feats == ["dow", "month", "is_weekend", "_cnt_prev", "_amount_prev_mean"]
    assert "order_id" not in x.columns and any(c.startswith("src_") for c in x.columns)


def test_split_is_deterministic_and_about_a_quarter(spark):
    df = spark.range(20000).withColumnRenamed("id", "order_id")
    a = FE.split(df, "order_id").where("is_test").count()
    b = FE.split(df.repartition(7), "order_id").where("is_test").count()
    assert a == b and 0.23 < a / 20000 < 0.27


def _brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_auc_curves_confusion(spark):
    rnd = random.Random(7)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 1)) for _ in range(300)]
    sc = spark.createDataFrame(rows, "label int, score double")
    assert abs(ML.roc_auc(sc, "label").first()[0] - _brute_auc(*zip(*rows))) < 1e-12
    roc = ML.roc_curve(sc, "label").orderBy(F.desc("threshold")).collect()
    assert roc[-1].tpr == 1.0 and roc[-1].fpr == 1.0
    cm = ML.confusion_matrix(ML.threshold_predict(sc), "label").collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == 300


def test_logreg_matches_l2_objective_optimum(spark):
    rng = np.random.default_rng(0)
    n = 600
    X = rng.normal(size=(n, 2))
    y = (X[:, 0] * 1.5 - X[:, 1] + rng.normal(size=n) * 0.5 > 0.8).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(X, y)], "x1 double, x2 double, y int")
    model = ML.train_logreg(df, ["x1", "x2"], "y", balanced=True, tol=1e-10)
    lr = model.stages[-1]
    w, b = lr.coefficients.toArray(), lr.intercept
    cw = {c: n / (2 * (y == c).sum()) for c in (0, 1)}
    s = np.array([cw[c] for c in y])
    p = 1 / (1 + np.exp(-(X @ w + b)))
    grad_w = w + (s * (p - y)) @ X                    # scikit-learn objective, C = 1
    grad_b = (s * (p - y)).sum()
    assert np.abs(grad_w).max() < 1e-3 and abs(grad_b) < 1e-3


def test_forest_beats_mean_predictor(spark):
    rng = np.random.default_rng(1)
    X = rng.uniform(0, 10, size=(800, 2))
    y = 3 * X[:, 0] + rng.normal(0, 1, 800)
    df = spark.createDataFrame([(float(a), float(b), float(c), i) for i, ((a, b), c) in enumerate(zip(X, y))],
                               "a double, b double, y double, id long")
    m = ML.train_regression(df, "y", key="id", num_trees=10, max_depth=6).first()
    assert m.r2 > 0.8
