"""Profiling and aggregation.

Each statistic family is a single aggregation pass producing one wide row (or
one row per group) that is then turned long with ``inline`` — never one job per
column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ID_COLUMNS, bind_scalar, day_of, nan_to_null, numeric_columns, qcol, safe_pearson
from ..functions.quantiles import quantile_table

_QS = [0.25, 0.5, 0.75]


def _moments(cols: list[str]) -> list:
    out = []
    for i, c in enumerate(cols):
        x = nan_to_null(qcol(c).cast("double"))
        out.append(F.struct(F.count(x).cast("long").alias("count"), F.avg(x).alias("mean"),
                            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
                   .alias(f"_m{i}"))
    return out


def _describe_rows(cols: list[str], q) -> list:
    """array of per-column structs from the moment columns ``_m<i>`` and the
    quantile arrays ``q(c)``."""
    return [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}.count").alias("count"),
                     F.col(f"_m{i}.mean").alias("mean"), F.col(f"_m{i}.std").alias("std"),
                     F.col(f"_m{i}.min").alias("min"), q(c)[0].alias("q25"), q(c)[1].alias("q50"),
                     q(c)[2].alias("q75"), F.col(f"_m{i}.max").alias("max"))
            for i, c in enumerate(cols)]


def describe(df: DataFrame, columns: list[str] | None = None, exclude_ids: bool = True,
             accuracy: int | None = None, method: str = "auto") -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear; exact unless
    ``accuracy`` is given, see ``functions.quantiles``), max per numeric column,
    one row per column."""
    cols = columns or numeric_columns(df, exclude=ID_COLUMNS if exclude_ids else ())
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, count long, mean double, std double, min double, q25 double, "
                "q50 double, q75 double, max double")
    m = "approx" if accuracy else method
    if m == "auto":
        # the moments ride along in the first scan of the quantiles
        row = quantile_table(df, cols, _QS, extra_aggs=_moments(cols))
        return row.select(F.inline(F.array(*_describe_rows(cols, lambda c: qcol(c)))))
    qt = quantile_table(df, cols, _QS, method=m, accuracy=accuracy or 10_000)
    row, q = bind_scalar(df.agg(*_moments(cols)), qt.select(F.struct(*[qcol(c) for c in cols])).scalar(), "_q")
    return row.select(F.inline(F.array(*_describe_rows(cols, lambda c: q.getField(c)))))


def describe_by(df: DataFrame, by: str = "source", columns: list[str] | None = None,
                exclude_ids: bool = True, accuracy: int | None = None, method: str = "auto") -> DataFrame:
    """P1 per group (null groups dropped)."""
    cols = columns or numeric_columns(df, exclude=tuple(ID_COLUMNS if exclude_ids else ()) + (by,))
    m = "approx" if accuracy else method
    if m == "auto":
        j = quantile_table(df, cols, _QS, by=by, extra_aggs=_moments(cols))
        return j.select(qcol(by), F.inline(F.array(*_describe_rows(cols, lambda c: qcol(c)))))
    base = df.where(qcol(by).isNotNull())
    mom = base.groupBy(qcol(by).alias(by)).agg(*_moments(cols))
    qt = quantile_table(base, cols, _QS, by=by, method=m, accuracy=accuracy or 10_000)
    qt = qt.select(qcol(by), *[qcol(c).alias(f"_q{i}") for i, c in enumerate(cols)])
    j = mom.join(qt, by)
    return j.select(qcol(by), F.inline(F.array(*_describe_rows(cols, lambda c: F.col(f"_q{cols.index(c)}")))))


def date_range(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """First and last date."""
    d = day_of(df, date_col)
    return df.agg(F.min(d).alias("date_min"), F.max(d).alias("date_max"))


def source_counts(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows per source, null source counted as its own group."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).alias("rows"))


def aggregates_by_source(df: DataFrame, source_col: str = "source", amount_col: str = "amount") -> DataFrame:
    """P5: per non-null source: all rows, and sum / mean of the non-null amounts
    (sum of none is 0.0, mean of none is NULL; no amount column -> both NULL)."""
    if source_col not in df.columns:
        return df.sparkSession.createDataFrame([], "source string, rows long, amount_sum double, amount_mean double")
    if amount_col in df.columns:
        a = nan_to_null(qcol(amount_col).cast("double"))
        s, m = F.coalesce(F.sum(a), F.lit(0.0)), F.avg(a)
    else:
        s = m = F.lit(None).cast("double")
    return (df.where(qcol(source_col).isNotNull()).groupBy(qcol(source_col).alias("source"))
              .agg(F.count(F.lit(1)).alias("rows"), s.alias("amount_sum"), m.alias("amount_mean")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows (NULL equals NULL), as one row ``duplicates``.
    The group-by over all columns combines map-side, so a hot group of copies is
    reduced to one row per map task before the shuffle."""
    g = df.groupBy(*[qcol(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def overall_metrics(raw: DataFrame, clean: DataFrame, amount_col: str = "amount") -> DataFrame:
    """One row of run metrics over the raw and the cleaned frame."""
    dups = duplicate_rows(raw)
    raw_n = raw.agg(F.count(F.lit(1)).alias("rows_raw"))
    if amount_col in clean.columns:
        a = nan_to_null(qcol(amount_col).cast("double"))
        c = clean.agg(F.struct(
            F.count(F.lit(1)).alias("rows_clean"),
            F.count_if(a.isNull()).cast("long").alias("missing_amount_clean"),
            F.coalesce(F.sum(a), F.lit(0.0)).alias("total_revenue_clean"),
            F.avg(a).alias("avg_order_amount_clean"))).scalar()
    else:
        c = clean.agg(F.struct(
            F.count(F.lit(1)).alias("rows_clean"), F.lit(0).cast("long").alias("missing_amount_clean"),
            F.lit(None).cast("double").alias("total_revenue_clean"),
            F.lit(None).cast("double").alias("avg_order_amount_clean"))).scalar()
    d = dups.scalar()
    raw_n, c = bind_scalar(raw_n, c)
    return raw_n.select(
        F.col("rows_raw"), c.getField("rows_clean").alias("rows_clean"),
        F.when(F.col("rows_raw") > 0, d).otherwise(F.lit(0)).cast("long").alias("duplicates_raw"),
        c.getField("missing_amount_clean").alias("missing_amount_clean"),
        c.getField("total_revenue_clean").alias("total_revenue_clean"),
        c.getField("avg_order_amount_clean").alias("avg_order_amount_clean"))


def correlation(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson matrix (long form col_a, col_b, rho) over numeric non-ID columns,
    pairwise-complete; fewer than two columns -> no rows.  A zero-variance column
    yields NULL, never a division error."""
    cols = columns or numeric_columns(df, exclude=ID_COLUMNS)
    schema = "col_a string, col_b string, rho double"
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], schema)
    x = {c: nan_to_null(qcol(c).cast("double")) for c in cols}
    cells = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                  safe_pearson(x[a], x[b]).alias("rho")))
    half = df.agg(F.array(*cells).alias("s")).select(F.inline("s"))
    # mirror the upper triangle (the aggregate is one row, so this is tiny)
    lower = half.where(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "rho")
    return half.unionByName(lower)


def table_counts(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Row counts of the two tables, as one row."""
    n_cust = customers.agg(F.count(F.lit(1))).scalar()
    return sales.agg(F.count(F.lit(1)).alias("sales_count")).select("sales_count", n_cust.alias("customers_count"))


def top_countries(sales: DataFrame, customers: DataFrame, k: int = 3) -> DataFrame:
    """Countries by joined order count, top k (ties by country name).

    Orders are counted per customer before the join (eager aggregation): the
    join then sees one row per customer instead of one per order, and a hot
    customer is combined map-side."""
    per_cust = sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id") \
                    .agg(F.count(F.lit(1)).alias("_n"))
    j = per_cust.join(customers.select("customer_id", "country"), "customer_id")
    return (j.groupBy("country").agg(F.sum("_n").alias("cnt"))
             .orderBy(F.desc("cnt"), F.asc("country")).limit(k))
