"""Exact quantiles: the narrowing plan and the sort method equal numpy's linear quantiles and
Spark's hash aggregate, including ties, NULLs, NaN and a hot group."""

import random

import numpy as np
import pandas as pd
import pytest

from ledgerflow.functions.quantiles import quantile_table
from ledgerflow.operators.report import box_stats

PROBS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", "c"])
        x = None if i % 17 == 0 else float(rnd.randint(0, 200))          # many ties
        y = float("nan") if i % 23 == 0 else rnd.random() * 1000.0
        rows.append((g, x, y))
    return spark.createDataFrame(rows, "g string, x double, y double"), rows


def _np(vals):
    v = np.array([a for a in vals if a is not None and not np.isnan(a)])
    return list(np.quantile(v, PROBS))


@pytest.mark.parametrize("method", ["sort", "hash", "auto"])
def test_global(spark, data, method):
    df, rows = data
    r = quantile_table(df, ["x", "y"], PROBS, method=method).first()
    assert np.allclose(r.x, _np([a for _, a, _ in rows]), atol=1e-9)
    assert np.allclose(r.y, _np([b for _, _, b in rows]), atol=1e-9)


@pytest.mark.parametrize("method", ["sort", "hash", "auto"])
def test_grouped(spark, data, method):
    df, rows = data
    got = {r.g: r.x for r in quantile_table(df, ["x"], PROBS, by="g", method=method).collect()}
    for g in {r[0] for r in rows}:
        assert np.allclose(got[g], _np([a for gg, a, _ in rows if gg == g]), atol=1e-9)


def test_approx_close(spark, data):
    df, rows = data
    r = quantile_table(df, ["y"], [0.5], method="approx", accuracy=10000).first()
    assert abs(r.y[0] - _np([b for _, _, b in rows])[2]) < 5.0


def test_tiny_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert quantile_table(df, ["x"], PROBS).first().x == [1.0] * len(PROBS)
    e = spark.createDataFrame([], "x double")
    assert quantile_table(e, ["x"], [0.5]).first().x == [None]


def test_narrowing_takes_several_scans(spark):
    """More values than a sketch shows, heavy ties at a quantile, heavy tails, one group with 90 % of the rows."""
    rng = np.random.default_rng(5)
    n = 300_000
    g = np.where(rng.random(n) < 0.9, "hot", np.where(rng.random(n) < 0.5, "a", "b"))
    x = np.exp(rng.normal(0, 8, n)) * np.where(rng.random(n) < 0.5, 1, -1)
    y = np.where(rng.random(n) < 0.5, 5.0, 6.0)
    y[::1000] = rng.random(len(y[::1000])) * 1e6
    pdf = pd.DataFrame({"g": g, "x": x, "y": y})
    df = spark.createDataFrame(pdf)
    r = quantile_table(df, ["x", "y"], PROBS).first()
    assert np.allclose(r.x, np.quantile(x, PROBS), rtol=1e-12)
    assert np.allclose(r.y, np.quantile(y, PROBS), rtol=1e-12)
    for row in quantile_table(df, ["x", "y"], PROBS, by="g").collect():
        mine = pdf[pdf.g == row.g]
        assert np.allclose(row.x, np.quantile(mine.x, PROBS), rtol=1e-12)
        assert np.allclose(row.y, np.quantile(mine.y, PROBS), rtol=1e-12)


def test_box_stats_shuffles_no_rows(spark):
    """90 % of the rows in one group, automatic broadcast off: every exchange follows a partial aggregate."""
    rows = [("hot" if i % 10 else "b", float(i * 7919 % 5003)) for i in range(6000)]
    df = spark.createDataFrame(rows, "source string, amount double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = box_stats(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.source: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = [nxt for line, nxt in zip(plan.splitlines(), plan.splitlines()[1:]) if "Exchange hashpartitioning(grp" in line]
    assert below and all("partial_" in b or "Project [_g" in b for b in below)      # aggregates, or one row per group
    for s in ("hot", "b"):
        v = np.array([x for g, x in rows if g == s])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (got[s].n, got[s].q1, got[s].q3, got[s].whisker_lo, got[s].whisker_hi) == (len(v), q1, q3, inside.min(), inside.max())


def test_many_groups_are_sorted(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ledgerflow.functions import quantiles as Q

    df = spark.createDataFrame([(f"g{i % 12}", None if i % 12 == 5 else float(i * 37 % 101)) for i in range(600)], "g string, x double")
    extra = [F.count("x").alias("n")]
    want = sorted(map(str, quantile_table(df, ["x"], PROBS, by="g", extra_aggs=extra).collect()))
    monkeypatch.setattr(Q, "GROUPS", 11)
    monkeypatch.setattr(Q, "_scan_codes", None)                      # nothing is fetched per group
    got = quantile_table(df, ["x"], PROBS, by="g", extra_aggs=extra)
    assert sorted(map(str, got.collect())) == want
    assert len(quantile_table(df, ["x"], PROBS, by="g").collect()) == 12


def test_brackets_with_too_many_values_are_sketched_again(spark, monkeypatch):
    from ledgerflow.functions import quantiles as Q

    monkeypatch.setattr(Q, "VALUES", 20)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(0, 1, 40_000), np.full(20_000, 0.25), rng.normal(0, 1e-9, 20_000)])
    r = quantile_table(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"], PROBS).first()
    assert np.allclose(r.x, np.quantile(x, PROBS), rtol=1e-12)
