"""Iceberg cube against a full cube; merged states against one scan of everything."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.cube import iceberg_cube
from ledgerflow.operators.profile import describe
from ledgerflow.plans import states
from ledgerflow.session import scratch_path


def as_rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("least", [1, 20, 90, 10_000])
def test_cube_keeps_what_a_full_cube_has(spark, least):
    rng = random.Random(1)
    data = [(rng.choice(["hot", "hot", "a", None]), rng.randint(0, 3), rng.choice([1.5, None, 2.0]), rng.choice([None, 2, 3])) for _ in range(600)]
    df = spark.createDataFrame(data, "a string, b int, c double, `n` int")
    df.createOrReplaceTempView("to_cube")
    want = spark.sql(f"SELECT a, b, c, int(grouping_id()) AS level, count(*) AS n, sum(n) AS total FROM to_cube GROUP BY CUBE (a, b, c) HAVING count(*) >= {least}")
    got = iceberg_cube(df, ["a", "b", "c"], least, {"total": F.col("n")})
    assert got.columns == want.columns and as_rows(got) == as_rows(want)
    assert iceberg_cube(df.limit(0), ["a", "b"], 1).count() == 0


def test_pruned_groupings_read_no_rare_cells(spark, monkeypatch):
    from ledgerflow.operators import cube

    seen, cut = [], cube.cut_lineage
    monkeypatch.setattr(cube, "cut_lineage", lambda d: seen.append(d.columns) or cut(d))
    df = spark.range(1000).select(F.col("id").alias("unique"), (F.col("id") % 2).alias("half"), F.lit(1).alias("one"))
    got = iceberg_cube(df, ["unique", "half", "one"], 100)
    assert got.count() == 1 + 2 + 1 + 2                      # total, half, one, half x one
    assert len(seen) == 1 + 1 + 3 + 1                        # finest, total, three single columns, half x one


def test_bins_never_fall(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 10.0 ** k, 300) for k in range(-300, 300, 37)] + [2.0 ** np.arange(-1074, 1023, 13), np.nextafter(2.0 ** np.arange(-50, 50), 0),
                       [0.0, -0.0, 5e-324, -5e-324, 1.7e308, math.inf, -math.inf]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", states.bin_of(F.col("x")).alias("b"))
    b = [r.b for r in df.orderBy("x").collect()]
    assert None not in b and b == sorted(b)


def test_batches_merge_to_the_whole(spark):
    rng = np.random.default_rng(4)
    folder, cols = scratch_path(spark, "states"), ["x", "odd name", "none"]
    batch = lambda n, at: spark.createDataFrame(
        [(float(v), None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i % 5) - 2, None) for i, v in enumerate(rng.normal(at, 3, n))],
        "x double, `odd name` double, none double")
    parts = [batch(500, 1e6), batch(1, -5), batch(333, 0)]
    for k, p in enumerate(parts):
        states.append_batch(p, cols, folder, f"b{k}")
        whole = parts[0]
        for q in parts[1:k + 1]:
            whole = whole.unionByName(q)
        got = {r["column"]: r for r in states.merged_stats(spark, cols, folder).collect()}
        want = {r["column"]: r for r in describe(whole, cols).collect()}
        for c in cols:
            a, b = got[c], want[c]
            assert [a["count"], a["min"], a["max"]] == [b["count"], b["min"], b["max"]]
            for name in ("mean", "std", "q25", "q50", "q75"):
                u, v = a[name], b[name]
                assert u == v or u is not None and v is not None and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12), (c, name, u, v)
    states.append_batch(parts[2], cols, folder, "b2")        # once more: nothing doubles
    assert {r["column"]: r["count"] for r in states.merged_stats(spark, cols, folder).collect()}["x"] == 834


def test_an_old_batch_is_not_read_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    folder = scratch_path(spark, "states")
    for k in range(3):
        df = spark.range(100).select((F.col("id") + 100 * k).cast("double").alias("x"))
        states.append_batch(df.mapInArrow(count, df.schema), ["x"], folder, str(k))
    r = states.merged_stats(spark, ["x"], folder).first()
    assert (r["count"], r.min, r.q50, r.max) == (300, 0.0, 149.5, 299.0) and seen.value <= 2 * 300      # the range bounds' sample reads a batch, too
