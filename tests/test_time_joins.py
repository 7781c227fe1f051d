"""As-of and interval joins, ranks and table differences against plain loops, with a hot key."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import asof, diff, intervals, ranking


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    left = [(key(), rng.choice([None, *range(60)]), i) for i in range(300)]
    right = [(key(), rng.choice([None, *range(0, 60, 3)]), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(120)]
    return left + left[:20], right + right[:5]


@pytest.mark.parametrize("equal", [True, False])
def test_asof_equals_brute_force(spark, events, equal):
    left, right = events
    l = spark.createDataFrame(left, "k string, t long, p long")  # noqa: E741
    r = spark.createDataFrame(right, "k string, t long, v double")

    def last(k, t):
        got = [(x, v is not None, v) for kk, x, v in right if k is not None and kk == k and t is not None and x is not None and (x <= t if equal else x < t)]
        return (max(got)[0], max(got)[2]) if got else (None, None)

    got = asof.asof_join(l, r, "k", "t", "t", ["v"], equal, partitions=7)
    assert got.columns == ["k", "t", "p", "t_right", "v"]
    assert rows(got) == sorted(str((k, t, p, *last(k, t))) for k, t, p in left)
    assert asof.asof_join(l.limit(0), r, "k", "t", "t", ["v"]).count() == 0
    assert rows(asof.asof_join(l, r.limit(0), "k", "t", "t", ["v"])) == sorted(str((k, t, p, None, None)) for k, t, p in left)


def test_asof_carries_over_many_partitions(spark):
    l = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))  # noqa: E741
    r = spark.createDataFrame([("hot", 5, "x"), ("hot", 1500, "y")], "k string, at long, v string")
    got = asof.asof_join(l, r, "k", "t", "at", ["v"], partitions=20).groupBy("v").count().collect()
    assert {x["v"]: x["count"] for x in got} == {None: 5, "x": 1495, "y": 500}


@pytest.mark.parametrize("base", [1, 5])
def test_interval_pairs_equal_brute_force(spark, base):
    rng = random.Random(base)
    span = lambda: (lambda a: (a, a + rng.choice([0, 0, 1, 2, 3, 9, 40, 300, -1])))(rng.randint(-200, 200))
    left = [(i, rng.choice(["a", "b", None]), *span()) for i in range(150)] + [(900, "a", None, 3), (901, "a", -10**12, 10**12)]
    right = [(i, rng.choice(["a", "b"]), *(span() if i % 2 else (7, 9))) for i in range(120)] + [(i, "a", 7, 9) for i in range(5)]
    l, r = (spark.createDataFrame(x, "id long, k string, a long, b long") for x in (left, right))  # noqa: E741
    over = lambda x, y: None not in (x[2], x[3]) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    got = intervals.interval_join(l, r, ("a", "b"), ("a", "b"), base=base)
    assert got.columns == ["id", "k", "a", "b", "id_right", "k_right", "a_right", "b_right"]
    assert rows(got) == sorted(str((*x, *y)) for x in left for y in right if over(x, y))
    keyed = intervals.interval_join(l, r, ("a", "b"), ("a", "b"), ["k"], base)
    assert rows(keyed) == sorted(str((*x, y[0], *y[2:])) for x in left for y in right if over(x, y) and x[1] == y[1] is not None)
    assert intervals.interval_join(l.limit(0), r, ("a", "b"), ("a", "b")).count() == 0
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_points_fall_into_windows_of_dates(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    p = spark.createDataFrame([(i, day(i % 40)) for i in range(100)], "id long, day date")
    w = spark.createDataFrame([("x", day(3), day(5)), ("y", day(4), day(30)), ("z", day(90), day(91))], "name string, a date, b date")
    got = {r["name"]: r["count"] for r in intervals.interval_join(p, w, ("day", "day"), ("a", "b")).groupBy("name").count().collect()}
    assert got == {"x": 9, "y": sum(4 <= i % 40 <= 30 for i in range(100))}


def test_one_hot_day_is_cut_into_blocks(spark, monkeypatch):
    """All pairs of a day, with repeated rows, a map column and keys of other types, and no task has most of them."""
    monkeypatch.setattr(intervals, "BLOCK", 400, raising=False)
    monkeypatch.setattr(intervals, "TASK", 4000, raising=False)
    left = [(i, i % 2, 5, 5 + i % 3) for i in range(200)] + [(7, 1, 5, 6)] * 3 + [(1, 0, 30, 90)]
    right = [(i, 5 - i % 2, 6) for i in range(150)] + [(3, 4, 6)] * 2 + [(9, 60, 400)]
    l = spark.createDataFrame(left, "id long, k int, a long, b long").withColumn("m", F.create_map("id", "a"))  # noqa: E741
    r = spark.createDataFrame(right, "id long, a long, b long")
    over = lambda x, y: x[2] <= y[2] and y[1] <= x[3]
    got = intervals.interval_join(l, r, ("a", "b"), ("a", "b"))
    assert rows(got.drop("m")) == sorted(str((*x, *y)) for x in left for y in right if over(x, y))
    sizes = [x["count"] for x in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < sum(sizes) / 2
    for kind in ("long", "double", "int", "string"):
        q = r.withColumn("k", F.lit(1).cast(kind))
        keyed = intervals.interval_join(l.withColumn("k", F.col("k").cast("string")) if kind == "string" else l, q, ("a", "b"), ("a", "b"), ["k"])
        assert keyed.count() == sum(over(x, y) for x in left for y in right if x[1] == 1)


def test_rows_of_one_span_pass_in_lists(spark, monkeypatch):
    """The result has runs of either side's columns, so its files stay small; values come as they were, negative zero and nulls too."""
    for name, n in (("BLOCK", 5000), ("TASK", 20_000), ("FILES", 20_000), ("LIST", 16)):
        monkeypatch.setattr(intervals, name, n, raising=False)
    l = spark.range(1200).select("id", F.expr("(id % 2 * 2 - 1) * 0D").alias("K"), (F.col("id") % 6).cast("int").alias("t"),  # noqa: E741
                                 F.when(F.col("id") % 3 == 0, F.array("id")).alias("v")).coalesce(1)
    r = spark.range(90).select("id", F.lit(0.0).alias("k"), (F.col("id") % 5).alias("a"), (F.col("id") % 5 + F.col("id") % 7).alias("b")).coalesce(1)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:                    # as for tables of size
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        met = intervals.interval_join(l, r, ("t", "t"), ("a", "b"), ["k"]).select("id", F.col("K").cast("string"), "t", F.col("v")[0], "id_right").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    want = sorted((i, ("0.0", "-0.0")[i % 2 == 0], i % 6, i if i % 3 == 0 else -1, j) for i in range(1200) for j in range(90) if j % 5 <= i % 6 <= j % 5 + j % 7)
    assert sorted((x[0], x[1], x[2], -1 if x[3] is None else x[3], x[4]) for x in met) == want
    assert sum(x.id_right != y.id_right for x, y in zip(met, met[1:])) < len(met) / 8


def test_few_other_pairs_are_compared(spark):
    """Points against long spans: at least half of the pairs that share a place are in the result."""
    p = spark.range(3000).select("id", (F.col("id") % 1000).alias("t"))
    s = spark.range(200).select("id", (F.col("id") * 4).alias("a"), (F.col("id") * 4 + 130).alias("b"))
    got = intervals.interval_join(p, s, ("t", "t"), ("a", "b"))
    l, r = intervals._spans(p, "t", "t", [], 1, "l"), intervals._spans(s, "a", "b", [], 1, "r")  # noqa: E741
    levels = [x[0] for x in r.select("rlevel").distinct().collect()]
    met = intervals._placed(l, levels, levels, 1, "l").join(intervals._placed(r, [], levels, 1, "r"), F.expr("lat = rat AND lbin = rbin")).count()
    assert got.count() <= met <= 2 * got.count()
    assert intervals._placed(r, [], levels, 1, "r").groupBy("rc0").count().agg(F.max("count")).first()[0] <= 5


def test_ranks_equal_windows(spark):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(8)]), i) for i in range(400)]
    df = spark.createDataFrame(data, "g string, x long, id long")
    df.createOrReplaceTempView("to_rank")
    sql = lambda e, o="x": rows(spark.sql(f"SELECT g, x, id, CASE WHEN g IS NOT NULL THEN {e} OVER (PARTITION BY g ORDER BY {o}) END FROM to_rank"))
    got = ranking.ranked(df, "g", ["x"], partitions=5)
    assert rows(got.drop("dense_rank")) == sql("rank()") and rows(got.drop("rank")) == sql("dense_rank()")
    assert rows(ranking.numbered(df, "g", ["x", "id"], 5).drop("group_rows")) == sql("row_number()", "x, id")
    for k in (1, 3, 7, 1000):
        assert rows(ranking.ntiles(df, "g", ["x", "id"], k, 5)) == sql(f"ntile({k})", "x, id")
    assert rows(ranking.shifted(df, "g", ["x", "id"], "x", 2, partitions=5)) == sql("lag(x, 2)", "x, id")
    assert rows(ranking.shifted(df, "g", ["x", "id"], "id", -1, "lead", 5)) == sql("lead(id)", "x, id")
    assert ranking.ranked(df.limit(0), "g", ["x"]).count() == 0


def test_differences_by_key(spark):
    rng = random.Random(2)
    old = [(i, rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.0])) for i in range(300)] + [(None, "n", 1.0), (7, "twice", 1.0), (8, "gone", 0.0)]
    new = [r for r in old if r[0] != 20] + [(5000, "new", None), (7, "twice", 1.0)]
    new = [(i, "z" if i == 33 else s, None if i == 34 else x) for i, s, x in new if (i, s) != (8, "gone")]
    new = [(i, s, 9.0 if i is None else x) for i, s, x in new]
    schema = "id long, s string, x double"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame([(x, s, i) for i, s, x in new], "x double, s string, id long")
    got = {r["id"]: (r["change"], r["columns"]) for r in diff.table_diff(a, b, ["id"], buckets=16).collect()}

    def by_key(data):
        out = collections.defaultdict(list)
        for i, s, x in data:
            out[i].append((s, x))
        return out

    o, n = by_key(old), by_key(new)
    count = collections.Counter
    want = {}
    for k in {*o, *n}:
        if k not in o or k not in n:
            want[k] = ("added" if k not in o else "removed", None)
        elif count(o[k]) != count(n[k]):
            want[k] = ("changed", [c for j, c in enumerate(("s", "x")) if count(v[j] for v in o[k]) != count(v[j] for v in n[k])])
    assert got == want
    assert diff.table_diff(a, a, ["id"]).count() == 0 and diff.table_diff(a.limit(0), a, ["id"]).count() == len(o)


def test_equal_buckets_are_not_read_again(spark):
    a = spark.range(10_000).select("id", (F.col("id") * 2).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    d = diff.bucket_digests(a, ["id"], ["id", "v"], 512).join(diff.bucket_digests(b, ["id"], ["id", "v"], 512), ["bucket", "n", "d1", "d2"], "left_anti")
    assert d.count() == 1 and [tuple(r) for r in diff.table_diff(a, b, ["id"], 512).collect()] == [(77, "changed", ["v"])]
