"""Exact quantiles by one plan, whole-table and grouped, at any size.

numpy/pandas "linear" quantiles: position = p·(n − 1) in the sorted non-null
values, interpolated between the neighbouring ranks.

Methods
- ``auto`` (= ``narrow``): the first scan sketches every group with
              ``percentile_approx``.  Each wanted rank gets an open bracket of two
              neighbouring sketch values.  The ends of all open brackets cut a
              column's values into a few codes; the next scan counts the rows per
              code and fetches the inside of the brackets, its values where few are
              left, else a new sketch.  A scan shrinks a bracket some 250-fold,
              whatever the values' distribution: 10^6 rows take two scans, 10^11
              rows four.  Every scan is one map-side combined aggregation: no
              rows are shuffled, a hot group is split like any other, and a few
              rows per group reach the driver.  Where the first scan shows more
              than ``GROUPS`` groups, ``sort`` is taken instead.
- ``sort``:   values are ranked within their group by the skew-safe prefix count
              (range-partitioned sort), and two equi-joins fetch the neighbours.
              Nothing reaches the driver: the choice for keys with an unbounded
              number of groups.
- ``hash``:   Spark's ``percentile`` aggregate; a value→count map per group.
- ``approx``: ``percentile_approx`` with the given accuracy.

Result: one row per group (a single row without ``by``) holding, per column, an
``array<double>`` of the quantiles in ``probs`` order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import bind_scalar, nan_to_null, qcol
from .prefix import prefix_by_key

#: Points of a bracket's sketch, and the sketch's accuracy (far finer than its points).
GRID, SKETCH = 1000, 10_000
#: Brackets that can't hold more values than this are fetched instead of sketched.
VALUES = 5000
#: Groups beyond which nothing is fetched per group: values are ranked by sorting.
GROUPS = 20_000


def quantile_table(df: DataFrame, cols: list[str], probs: list[float], by: str | None = None,
                   method: str = "auto", accuracy: int = 10_000, extra_aggs: list | None = None) -> DataFrame:
    """``extra_aggs`` (``auto`` only): further aggregate columns over the same
    values and groups, computed in the first scan and returned alongside."""
    vals = df.select(*([qcol(by).alias("_g")] if by else [F.lit(0).alias("_g")]),
                     *[nan_to_null(qcol(c).try_cast("double")).alias(c) for c in cols])
    if by:
        vals = vals.where(F.col("_g").isNotNull())
    if method in ("auto", "narrow"):
        out = _narrowed_quantiles(vals, cols, probs, bool(by), extra_aggs or [], GROUPS if method == "auto" else None)
        if out is None:
            out = _sorted_table(vals, cols, probs, extra_aggs or [])
    elif method in ("hash", "approx"):
        parr = F.array(*[F.lit(float(p)) for p in probs])
        f = (lambda x: F.percentile_approx(x, parr, accuracy)) if method == "approx" else \
            (lambda x: F.percentile(x, parr))
        out = vals.groupBy("_g").agg(*[f(qcol(c)).alias(c) for c in cols])
    elif method == "sort":
        out = _sorted_table(vals, cols, probs, extra_aggs or [])
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    if by:
        return out.withColumnRenamed("_g", by)
    return out.drop("_g")


def _sorted_table(vals: DataFrame, cols: list[str], probs: list[float], extra_aggs: list) -> DataFrame:
    """The result by the ``sort`` method; a column without values in a group has null quantiles there."""
    groups = vals.groupBy("_g").agg(*extra_aggs) if extra_aggs else vals.select("_g").distinct()
    out = reduce(lambda a, b: a.join(b, "_g", "left"), [_sorted_quantiles(vals, c, probs) for c in cols], groups)
    none = F.array(*[F.lit(None).cast("double") for _ in probs])
    return out.select("_g", *[F.coalesce(qcol(c), none).alias(c) for c in cols], *[qcol(c) for c in groups.columns if c != "_g"])


def _sorted_quantiles(vals: DataFrame, c: str, probs: list[float]) -> DataFrame:
    x = vals.select("_g", qcol(c).alias("_x")).where(F.col("_x").isNotNull())
    ranked = prefix_by_key(x, "_g", ["_x"]).select("_g", "_x", F.col("_prev_n").alias("_r"))
    n = x.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    tgt = n.select("_g", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_i", "_p"))
    tgt = tgt.join(n, "_g").select("_g", "_i", (F.col("_p") * (F.col("_n") - 1)).alias("_pos"))
    tgt = tgt.select("_g", "_i", "_pos", F.floor("_pos").alias("_lo"), F.ceil("_pos").alias("_hi"))
    lo = ranked.select("_g", F.col("_r").alias("_lo"), F.col("_x").alias("_vlo"))
    hi = ranked.select("_g", F.col("_r").alias("_hi"), F.col("_x").alias("_vhi"))
    got = tgt.join(lo, ["_g", "_lo"]).join(hi, ["_g", "_hi"])
    # Spark's / numpy's linear interpolation between the neighbouring ranks
    q = F.when(F.col("_lo") == F.col("_hi"), F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi"))
    per = got.groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_i", q.alias("_q")))).alias("_a"))
    return per.select("_g", F.transform("_a", lambda s: s["_q"]).alias(c))


@dataclass(frozen=True)
class Bracket:
    """The values strictly between two ends (None: unbounded), and how many of them there may be."""

    lo: float | None
    hi: float | None
    most: int


@dataclass
class Inside:
    """What a scan found inside a bracket: rows up to its lower end, rows inside, and their values or their sketch."""

    upto: int
    m: int
    points: list[float]

    def exact(self) -> bool:
        return self.m <= len(self.points) // 2 or self.m == len(self.points)     # a sketch of few values holds each

    def value(self, rank: int) -> float:
        """The value at a rank of the whole group, if ``exact``."""
        r, n = rank - self.upto, len(self.points)
        return sorted(self.points)[r] if self.m == n else self.points[r * n // self.m]

    def around(self, rank: int, outer: Bracket) -> Bracket:
        """Two sketch values with the rank between them, or the ends of ``outer``."""
        r, n = rank - self.upto, len(self.points)
        a, b = r * n // self.m - 2, -(-(r + 1) * n // self.m)
        return Bracket(outer.lo if a < 0 else self.points[a], outer.hi if b >= n else self.points[b],
                       (b - a + 1) * self.m // n + 4 * self.m // SKETCH + 4)


def _grid_sketch(x: Column) -> Column:
    points = F.expr("array(" + ", ".join(f"{k / GRID}D" for k in range(1, GRID + 1)) + ")")
    return F.percentile_approx(x, points, SKETCH)


def _narrowed_quantiles(vals: DataFrame, cols: list[str], probs: list[float], grouped: bool, extra_aggs: list, most: int | None) -> DataFrame | None:
    """None if there are more than ``most`` groups."""
    spark = vals.sparkSession
    aggs = [a for i, c in enumerate(cols) for a in (F.count(qcol(c)).alias(f"_n{i}"), _grid_sketch(qcol(c)).alias(f"_s{i}"))] + extra_aggs
    first = vals.groupBy("_g").agg(*aggs) if grouped else vals.agg(F.lit(0).alias("_g"), *aggs)
    rows = (first.limit(most + 1) if grouped and most else first).collect()          # one row per group
    if grouped and most and len(rows) > most:
        return None
    sizes: dict[tuple, int] = {}             # (group, column) -> rows
    found: dict[tuple, float] = {}           # (group, column, rank) -> value
    open_: dict[tuple, Bracket] = {}         # (group, column, rank) -> bracket to scan

    def settle(key: tuple, inside: Inside, outer: Bracket) -> None:
        open_.pop(key, None)
        if inside.exact():
            found[key] = inside.value(key[2])
        else:
            open_[key] = inside.around(key[2], outer)

    for row in rows:
        for i in range(len(cols)):
            n = sizes[row["_g"], i] = row[f"_n{i}"]
            for rank in {r for p in probs for r in _ranks(p, n)} if n else ():
                settle((row["_g"], i, rank), Inside(0, n, row[f"_s{i}"]), Bracket(None, None, n))

    while open_:
        # The ends of a column's brackets, in order, cut its values into codes: 2k + 1 is the k-th end itself, 2k the values before it.
        cuts: dict[tuple, list[float]] = {}
        for (g, i, _), b in open_.items():
            cuts.setdefault((g, i), []).extend(x for x in (b.lo, b.hi) if x is not None)
        cuts = {k: sorted(set(v)) for k, v in cuts.items()}
        code = lambda g, i, b: (0 if b.lo is None else 2 * cuts[g, i].index(b.lo) + 2,
                                2 * (len(cuts[g, i]) if b.hi is None else cuts[g, i].index(b.hi)))
        want: dict[tuple, set[int]] = {}
        for (g, i, _), b in open_.items():
            first_code, last_code = code(g, i, b)
            want.setdefault((g, i), set()).update(range(first_code, last_code + 1, 2))
        few = max(b.most for b in open_.values()) <= VALUES
        got = _scan_codes(vals, cols, cuts, want, few, grouped)
        for key, b in list(open_.items()):
            g, i, rank = key
            upto = 0
            for c, m, points in got[g, i]:
                if rank < upto + m:
                    break
                upto += m
            ends = cuts[g, i]
            if c % 2:
                found[key] = ends[c // 2]
                del open_[key]
                continue
            inside = Bracket(ends[c // 2 - 1] if c else None, ends[c // 2] if c // 2 < len(ends) else None, m)
            if points:
                settle(key, Inside(upto, m, points), inside)
            else:                                            # beside the bracket: the sketch's error, go on there
                open_[key] = inside

    def quantile(g, i: int, p: float) -> float | None:
        n = sizes[g, i]
        if not n:
            return None
        lo, hi = _ranks(p, n)
        if lo == hi:
            return found[g, i, lo]
        pos = p * (n - 1)
        return (hi - pos) * found[g, i, lo] + (pos - lo) * found[g, i, hi]

    extra = first.schema.fields[1 + 2 * len(cols):]
    schema = T.StructType([T.StructField("_g", vals.schema["_g"].dataType),
                           *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in cols], *extra])
    out = [(row["_g"], *[[quantile(row["_g"], i, p) for p in probs] for i in range(len(cols))],
            *[row[f.name] for f in extra]) for row in rows]
    return spark.createDataFrame(out, schema)


def _scan_codes(vals: DataFrame, cols: list[str], cuts: dict[tuple, list[float]], want: dict[tuple, set[int]],
                few: bool, grouped: bool) -> dict[tuple, list[tuple[int, int, list[float]]]]:
    """Per (group, column): (code, rows, values or sketch of a wanted code) by code, from one aggregation by group, column and code."""
    spark = vals.sparkSession
    cells = []
    if grouped:
        table = {g: [(cuts.get((g, i)), sorted(want.get((g, i), ()))) for i in range(len(cols))] for g in {g for g, _ in cuts}}
        schema = T.StructType([T.StructField("m", T.MapType(vals.schema["_g"].dataType, T.ArrayType(T.StructType([
            T.StructField("ends", T.ArrayType(T.DoubleType())), T.StructField("want", T.ArrayType(T.IntegerType()))]))))])
        bound, m = bind_scalar(vals, spark.createDataFrame([(table,)], schema).scalar(), "_m")
        vals = bound.select("_g", *[qcol(c) for c in cols], F.try_element_at(m, F.col("_g")).alias("_b")).where(F.col("_b").isNotNull())
    for i, c in enumerate(cols):
        x, code = qcol(c), F.lit(0)
        for k in range(max([len(v) for (_, j), v in cuts.items() if j == i] or [0])):
            e = F.get(F.col("_b")[i]["ends"], k) if grouped else F.lit(cuts[0, i][k])
            code = code + F.when(x > e, 2).when(x == e, 1).otherwise(0)
        here = F.col("_b")[i]["ends"].isNotNull() if grouped else F.lit((0, i) in cuts)
        keep = F.array_contains(F.col("_b")[i]["want"], code) if grouped else code.isin(sorted(want.get((0, i), ())))
        cells.append(F.when(here & x.isNotNull(), F.struct(F.lit(i).alias("i"), code.alias("code"), F.when(keep, x).alias("x"))))
    long = vals.select("_g", F.inline(F.array_compact(F.array(*cells))))
    points = F.collect_list("x") if few else _grid_sketch(F.col("x"))
    out: dict[tuple, list] = {}
    for r in long.groupBy("_g", "i", "code").agg(F.count("*").alias("n"), points.alias("points")).orderBy("code").collect():
        out.setdefault((r["_g"], r["i"]), []).append((r["code"], r["n"], r["points"] or []))
    return out


def _ranks(p: float, n: int) -> tuple[int, int]:
    """The two neighbouring ranks (from 0) of the p-quantile of n values."""
    pos = p * (n - 1)
    return int(pos // 1), int(-(-pos // 1))
