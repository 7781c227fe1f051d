"""Report datasets (R1–R12): the numbers behind every chart, as tables.

Every function is DataFrame -> DataFrame.  One-row statistics (min/max,
quantiles) enter the row-level plan as scalar subqueries (``DataFrame.scalar``),
so each is computed once and broadcast as a value; nothing is collected.
Windows only ever run on aggregated series (one row per period), never on raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ID_COLUMNS, bin_edges, bin_index, bind_scalar, day_of, nan_to_null, numeric_columns, qcol
from ..functions.quantiles import quantile_table


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(nan_to_null(qcol(column).cast("double")).alias("x")).where(F.col("x").isNotNull())


def _range_stats(x: DataFrame, bins: int) -> Column:
    """Scalar struct(lo, width) of the values (see ``bin_edges``)."""
    st = x.agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    lo, width = bin_edges(F.col("mn"), F.col("mx"), bins)
    return st.select(F.struct(lo.alias("lo"), width.alias("width")).alias("s")).scalar()


def _histogram_of(x: DataFrame, bins: int) -> DataFrame:
    spark = x.sparkSession
    xs, s = bind_scalar(x, _range_stats(x, bins))
    counts = (xs.select(bin_index(F.col("x"), s.getField("lo"), s.getField("width"), bins).alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("cnt")))
    # All bins, including empty ones: a `bins`-row grid, outer-joined to the counts.
    grid, s2 = bind_scalar(spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")),
                           _range_stats(x, bins))
    lo, width = s2.getField("lo"), s2.getField("width")
    out = grid.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
        (lo + F.col("bin") * width).alias("bin_hi"),
        F.coalesce(F.col("cnt"), F.lit(0)).cast("long").alias("count"),
    )
    # No values at all -> no bins (lo is NULL).
    return out.where(F.col("bin_lo").isNotNull())


def histogram(df: DataFrame, column: str = "amount", bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed."""
    return _histogram_of(_values(df, column), bins)


def histogram_trimmed(df: DataFrame, column: str = "amount", q: float = 0.99, bins: int = 30,
                      accuracy: int | None = None, method: str = "auto") -> DataFrame:
    """R2: histogram of the values at or below the q-quantile."""
    x = _values(df, column)
    qt = quantile_table(x, ["x"], [q], method="approx" if accuracy else method, accuracy=accuracy or 10_000)
    x, cut = bind_scalar(x, qt.select(F.col("x")[0]).scalar(), "_cut")
    return _histogram_of(x.where(F.col("x") <= cut).drop("_cut"), bins)


def box_stats(df: DataFrame, column: str = "amount", by: str | None = "source", k: float = 1.5,
              accuracy: int | None = None, method: str = "auto") -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (furthest data point
    within k·IQR of the box) and the outlier count.  Rows with a null group are
    dropped; without ``by`` (or the column) everything is one group (key NULL)."""
    has_by = by is not None and by in df.columns
    # without a grouping column everything is one group, keyed by a constant
    key = qcol(by).cast("string") if has_by else F.lit("")
    x = df.select(key.alias("grp"), nan_to_null(qcol(column).cast("double")).alias("x"))
    x = x.where(F.col("x").isNotNull() & F.col("grp").isNotNull())
    qs = quantile_table(x, ["x"], [0.25, 0.5, 0.75], by="grp", method="approx" if accuracy else method,
                        accuracy=accuracy or 10_000)
    q = qs.select("grp", F.col("x")[0].alias("q1"), F.col("x")[1].alias("median"), F.col("x")[2].alias("q3"))
    reach = F.lit(k) * (F.col("q3") - F.col("q1"))
    fences = q.select(F.struct("grp", F.struct((F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))).alias("f"))
    # the fences, one entry per group, come to the rows as a scalar: no raw row is shuffled
    x, by_group = bind_scalar(x, fences.agg(F.map_from_entries(F.collect_list("f"))).scalar(), "_f")
    fence = F.try_element_at(by_group, F.col("grp"))
    x = x.select("grp", "x", F.col("x").between(fence["lo"], fence["hi"]).alias("inside"))
    wsk = x.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("inside"), F.col("x"))).alias("whisker_lo"),
        F.max(F.when(F.col("inside"), F.col("x"))).alias("whisker_hi"),
        F.count_if(~F.col("inside")).cast("long").alias("n_outliers"))
    # a whisker never ends inside the box
    out = (q.join(wsk, "grp").withColumn("whisker_lo", F.least("whisker_lo", "q1"))
           .withColumn("whisker_hi", F.greatest("whisker_hi", "q3")))
    grp = F.col("grp") if has_by else F.lit(None).cast("string")
    return out.select(grp.alias(by or "group"), F.col("n").cast("long").alias("n"), "q1", "median", "q3",
                      "whisker_lo", "whisker_hi", "n_outliers")


def orders_per_day(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Orders per calendar day (null dates dropped); days without orders are absent."""
    d = day_of(df, date_col).alias("day")
    return (df.select(d).where(F.col("day").isNotNull())
              .groupBy("day").agg(F.count(F.lit(1)).alias("orders")))


def top_customers(df: DataFrame, n: int = 10, id_col: str = "customer_id") -> DataFrame:
    """Top-n ids by row count; ties broken by the smaller id."""
    return (df.where(qcol(id_col).isNotNull()).groupBy(id_col)
              .agg(F.count(F.lit(1)).alias("orders"))
              .orderBy(F.desc("orders"), F.asc(id_col)).limit(n))


def customer_totals(df: DataFrame, id_col: str = "customer_id") -> DataFrame:
    """Header facts — rows and distinct (non-null) customers."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(qcol(id_col)).alias("n_customers"))


def _month(df: DataFrame, date_col: str) -> Column:
    return F.trunc(day_of(df, date_col), "month")


def monthly_revenue(df: DataFrame, date_col: str = "order_date", amount_col: str = "amount") -> DataFrame:
    """Revenue per month over rows with both a date and an amount."""
    base = df.select(_month(df, date_col).alias("month"), nan_to_null(qcol(amount_col)).alias("amount"))
    return (base.where(F.col("month").isNotNull() & F.col("amount").isNotNull())
                .groupBy("month").agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders")))


def monthly_revenue_header(df: DataFrame, date_col: str = "order_date", amount_col: str = "amount") -> DataFrame:
    """R7 header facts: rows with a date and an amount, first and last month."""
    base = df.select(_month(df, date_col).alias("month"), nan_to_null(qcol(amount_col)).alias("amount"))
    ok = base.where(F.col("month").isNotNull() & F.col("amount").isNotNull())
    return ok.agg(F.count(F.lit(1)).alias("n"), F.min("month").alias("month_first"),
                  F.max("month").alias("month_last"))


def monthly_revenue_by_source(df: DataFrame, date_col: str = "order_date", amount_col: str = "amount",
                              source_col: str = "source") -> DataFrame | None:
    """Revenue per (month, source); rows missing date, amount or source dropped.
    ``None`` when the frame has no source column (no chart in the reference)."""
    if source_col not in df.columns:
        return None
    base = df.select(_month(df, date_col).alias("month"), qcol(source_col).alias("source"),
                     nan_to_null(qcol(amount_col)).alias("amount"))
    return (base.where(F.col("month").isNotNull() & F.col("amount").isNotNull() & F.col("source").isNotNull())
                .groupBy("month", "source").agg(F.sum("amount").alias("revenue")))


def source_share(df: DataFrame, source_col: str = "source") -> DataFrame | None:
    """Rows and percentage per source; a null source is labelled "NA"."""
    if source_col not in df.columns:
        return None
    agg = (df.select(F.coalesce(qcol(source_col).cast("string"), F.lit("NA")).alias("source"))
             .groupBy("source").agg(F.count(F.lit(1)).alias("rows")))
    # the total is one value over the (one row per source) aggregate
    agg, total = bind_scalar(agg, agg.agg(F.sum("rows")).scalar(), "_total")
    return agg.select("source", "rows", (F.col("rows") * 100.0 / total).alias("share_pct"))


def cumulative_revenue_by_source(df: DataFrame, date_col: str = "order_date", amount_col: str = "amount",
                                 source_col: str = "source") -> DataFrame | None:
    """Running revenue per source over the days that source has orders.
    Aggregated to (source, day) first; the window then sees one row per day."""
    if source_col not in df.columns:
        return None
    base = df.select(day_of(df, date_col).alias("day"), qcol(source_col).alias("source"),
                     nan_to_null(qcol(amount_col)).alias("amount"))
    daily = (base.where(F.col("day").isNotNull() & F.col("amount").isNotNull() & F.col("source").isNotNull())
                 .groupBy("source", "day").agg(F.sum("amount").alias("revenue")))
    w = Window.partitionBy("source").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("source", "day", "revenue", F.sum("revenue").over(w).alias("cum_revenue"))


def identical_series(series: DataFrame, key: str = "source", order: str = "month", value: str = "revenue",
                     digits: int = 2) -> DataFrame:
    """Pairs (a < b) of keys whose value sequences, taken in ``order``, are equal
    (positions compared, not the order values themselves).

    Distributed and exact: each key gets a position-aware signature (count plus
    xor of hash(position, rounded value)); only keys sharing a signature become
    candidate pairs, and each candidate is verified position by position with an
    equi-join.  No series is collected into one row.
    """
    s = series.select(qcol(key).alias("k"), qcol(order).alias("o"), F.round(qcol(value), digits).alias("v"))
    # One row per period per key; the window partitions by key over an aggregated
    # series whose length is bounded by the calendar, not by the data volume.
    s = s.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    sig = s.groupBy("k").agg(F.count(F.lit(1)).alias("n"),
                             F.bit_xor(F.xxhash64("pos", "v")).alias("h"))
    a, b = sig.alias("a"), sig.alias("b")
    cand = (a.join(b, (F.col("a.n") == F.col("b.n")) & (F.col("a.h") == F.col("b.h")) & (F.col("a.k") < F.col("b.k")))
             .select(F.col("a.k").alias("ka"), F.col("b.k").alias("kb"), F.col("a.n").alias("n")))
    sa = s.select(F.col("k").alias("ka"), F.col("pos"), F.col("v").alias("va"))
    sb = s.select(F.col("k").alias("kb"), F.col("pos"), F.col("v").alias("vb"))
    chk = (cand.join(sa, "ka").join(sb, ["kb", "pos"])
               .groupBy("ka", "kb", "n").agg(F.count(F.when(F.col("va").eqNullSafe(F.col("vb")), 1)).alias("eq")))
    return chk.where(F.col("eq") == F.col("n")).select(F.col("ka").alias(f"{key}_a"), F.col("kb").alias(f"{key}_b"))


def pairwise_bins(df: DataFrame, columns: list[str] | None = None, bins: int = 10,
                  max_cells: int = 1_000_000) -> DataFrame:
    """Pair-plot data without scattering every row: for each pair of numeric
    non-ID columns (a <= b; a == b is the diagonal histogram) the counts of the
    2-D equal-width bins.

    One scan bins every column; when the joint grid (bins ** k cells) is small
    the rows are first counted per joint cell (map-side combined, at most
    ``max_cells`` groups) and the pair counts are marginals of that small table;
    otherwise each row emits its k(k+1)/2 pair cells, still pre-aggregated
    map-side before the shuffle."""
    cols = columns or numeric_columns(df, exclude=ID_COLUMNS)
    if not cols:
        return df.sparkSession.createDataFrame([], "x_col string, y_col string, x_bin int, y_bin int, count long")
    vals = df.select(*[nan_to_null(qcol(c).cast("double")).alias(c) for c in cols])
    mm = vals.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("mn", F.min), ("mx", F.max))])
    edges = [bin_edges(F.col(f"mn{i}"), F.col(f"mx{i}"), bins) for i in range(len(cols))]
    st_expr = mm.select(F.struct(*[F.struct(lo.alias("lo"), w.alias("w")).alias(f"c{i}")
                                   for i, (lo, w) in enumerate(edges)])).scalar()
    vals, st = bind_scalar(vals, st_expr)

    def b(c):
        e = st.getField(f"c{cols.index(c)}")
        return bin_index(qcol(c), e.getField("lo"), e.getField("w"), bins)

    binned = vals.select(*[b(c).alias(c) for c in cols])
    if (bins + 1) ** len(cols) <= max_cells:          # +1: the NULL "bin"
        binned = binned.groupBy(*[qcol(c) for c in cols]).agg(F.count(F.lit(1)).alias("_w"))
        weight = F.col("_w")
    else:
        weight = F.lit(1).cast("long")
    pairs = [F.struct(F.lit(a).alias("x_col"), F.lit(c).alias("y_col"),
                      qcol(a).alias("x_bin"), qcol(c).alias("y_bin"), weight.alias("w"))
             for i, a in enumerate(cols) for c in cols[i:]]
    exploded = binned.select(F.inline(F.array(*pairs))).where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return exploded.groupBy("x_col", "y_col", "x_bin", "y_bin").agg(F.sum("w").cast("long").alias("count"))
