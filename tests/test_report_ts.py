"""Report datasets and the time-series decomposition against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import report as R
from ledgerflow.operators import timeseries as TS


def test_histogram_last_bin_closed_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "amount double")
    h = {r.bin: r["count"] for r in R.histogram(df, "amount", 5).collect()}
    assert h == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1}
    assert np.histogram([0.0, 1.0, 10.0], bins=5)[0].tolist() == [h[i] for i in range(1, 6)]


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "amount double")
    h = [r["count"] for r in R.histogram(df, "amount", 30).orderBy("bin").collect()]
    assert h == np.histogram([3.0, 3.0], bins=30)[0].tolist()


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]], "source string, amount double")
    r = R.box_stats(df).first()
    q1, q3 = np.percentile([1, 2, 3, 4, 100], [25, 75])
    assert (r.q1, r.q3) == (q1, q3)
    assert r.whisker_lo == 1.0 and r.whisker_hi == 4.0 and r.n_outliers == 1


def test_top_customers_tie_break(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (3,), (9,), (None,), (None,), (None,)], "customer_id long")
    assert [(r.customer_id, r.orders) for r in R.top_customers(df, 2).collect()] == [(3, 2), (5, 2)]


def test_identical_series(spark):
    rows = []
    for m in range(1, 5):
        d = dt.date(2024, m, 1)
        rows += [("a", d, float(m)), ("b", d, float(m)), ("c", d, float(m) + (m == 3))]
    rows.append(("d", dt.date(2024, 1, 1), 1.0))
    s = spark.createDataFrame(rows, "source string, month date, revenue double")
    assert [tuple(r) for r in R.identical_series(s).collect()] == [("a", "b")]


def test_source_share_sums_to_100(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "source string")
    rows = {r.source: r.share_pct for r in R.source_share(df).collect()}
    assert rows == {"a": 50.0, "b": 25.0, "NA": 25.0}


def _np_decompose(y, period=7):
    n = len(y)
    h = period // 2
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = y[i - h:i + h + 1].sum() / period
    front, back = h, n - 1 - h
    npts = period - 1
    fl, bf = min(front + npts, back), max(back - npts, front)
    k, b = np.polyfit(np.arange(front, fl), trend[front:fl], 1)
    trend[:front] = k * np.arange(0, front) + b
    k, b = np.polyfit(np.arange(bf, back), trend[bf:back], 1)
    trend[back + 1:] = k * np.arange(back + 1, n) + b
    det = y - trend
    pm = np.array([det[i::period].mean() for i in range(period)])
    pm -= pm.mean()
    seas = np.tile(pm, n // period + 1)[:n]
    return trend, seas, det - seas


def test_decompose_matches_numpy(spark):
    rng = np.random.default_rng(1)
    n = 60
    y = 100 + np.arange(n) * 0.7 + 5 * np.sin(np.arange(n) * 2 * np.pi / 7) + rng.normal(0, 1, n)
    start = dt.date(2024, 1, 1)
    s = spark.createDataFrame([(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)],
                              "day date, value double")
    got = TS.decompose(s).orderBy("day").collect()
    trend, seas, resid = _np_decompose(y)
    assert np.allclose([r.trend for r in got], trend, atol=1e-8)
    assert np.allclose([r.seasonal for r in got], seas, atol=1e-8)
    assert np.allclose([r.resid for r in got], resid, atol=1e-8)
    assert TS.decompose_nan_counts(TS.decompose(s)).first().asDict() == {"trend_nan": 0, "seasonal_nan": 0,
                                                                          "resid_nan": 0}


def test_decompose_too_short_raises(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)],
                              "day date, value double")
    with pytest.raises(Exception):
        TS.decompose(s).collect()


def test_daily_dense_fills_gaps(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 4), 3.0), (None, 9.0),
                                (dt.date(2024, 1, 4), None)], "order_date date, amount double")
    out = [(r.day.day, r.value) for r in TS.daily_dense(df).orderBy("day").collect()]
    assert out == [(1, 2.0), (2, 0.0), (3, 0.0), (4, 3.0)]
    assert F is not None
