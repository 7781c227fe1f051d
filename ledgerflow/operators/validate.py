"""Validation (V1–V6): duplicates, missing values, types, outlier masks.

Outlier masks are added as boolean columns next to the data (Spark has no row
index to align a separate mask frame with).  Quantiles and moments come from a
single aggregation per statistic family, used as scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bind_scalar, nan_to_null, qcol
from ..functions.quantiles import quantile_table
from .clean import missing_counts


def check_duplicates(df: DataFrame) -> DataFrame:
    """V1: the worst column's duplicate count — max over columns of
    Σ(count(v) − 1) over non-null values — as one row ``duplicates``.

    One unpivot to (column, value) and a (column, value) count with map-side
    combining: a value repeated in a third of all rows still leaves each map task
    as a single partial row."""
    if not df.columns:
        return df.sparkSession.createDataFrame([(0,)], "duplicates long")
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), qcol(c).cast("string").alias("v")) for c in df.columns])
    cnt = (df.select(F.inline(pairs)).where(F.col("v").isNotNull())
             .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    per_col = cnt.groupBy("c").agg(F.sum(F.col("n") - 1).alias("d"))
    return per_col.agg(F.coalesce(F.max("d"), F.lit(0)).cast("long").alias("duplicates"))


def drop_duplicates(df: DataFrame, subset: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """V2: remove duplicate rows (all columns) or keep the first row per ``subset``
    key in ``order_by`` order (default: the smallest row).

    The subset form is an aggregation (``min_by``) rather than a window, so a hot
    key is combined map-side instead of being sorted in one task."""
    if not subset:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*subset).dropDuplicates()
    order = order_by or rest
    row = F.struct(*[qcol(c).alias(c) for c in rest])
    key = F.struct(*[qcol(c).alias(f"_o{i}") for i, c in enumerate(order)], row.alias("_row"))
    g = df.groupBy(*[qcol(c) for c in subset]).agg(F.min_by(row, key).alias("_r"))
    return g.select(*[qcol(c) for c in subset], "_r.*").select(*[qcol(c) for c in df.columns])


def check_missing(df: DataFrame) -> DataFrame:
    """V3: (column, dtype, missing) for every column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    m = missing_counts(df)
    mapping = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return m.select("column", mapping[F.col("column")].alias("dtype"), "missing")


def check_types(df: DataFrame) -> dict[str, str]:
    """V4: column -> type name (schema only, no job)."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def _quartiles(df: DataFrame, cols: list[str], accuracy: int | None, method: str = "auto"):
    """Scalar struct: per column the array [Q1, Q3] (see ``functions.quantiles``)."""
    qt = quantile_table(df, cols, [0.25, 0.75], method="approx" if accuracy else method, accuracy=accuracy or 10_000)
    return qt.select(F.struct(*[qcol(c) for c in cols])).scalar()


def outliers_iqr(df: DataFrame, columns: list[str], k: float = 1.5, accuracy: int | None = None,
                 prefix: str = "outlier_") -> DataFrame:
    """V5: adds ``outlier_<c>`` = x < Q1 − k·IQR or x > Q3 + k·IQR (strict,
    linear quantiles); NULL or non-numeric values -> False."""
    cols = [c for c in (columns or []) if c in df.columns]
    if not cols:
        return df
    base, q = bind_scalar(df, _quartiles(df, cols, accuracy), "_q")
    flags = []
    for c in cols:
        x = nan_to_null(qcol(c).try_cast("double"))
        q1, q3 = q.getField(c)[0], q.getField(c)[1]
        iqr = q3 - q1
        cond = (x < q1 - F.lit(k) * iqr) | (x > q3 + F.lit(k) * iqr)
        flags.append(F.coalesce(cond, F.lit(False)).alias(prefix + c))
    return base.select(*[qcol(c) for c in df.columns], *flags)


def outliers_zscore(df: DataFrame, columns: list[str], threshold: float = 3.0, accuracy: int | None = None,
                    prefix: str = "outlier_") -> DataFrame:
    """V6: robust z-score.  Mean and population std over the values inside
    [Q1, Q3] (all values if none), |z| > threshold (strict); std 0 or NULL ->
    every flag False."""
    cols = [c for c in (columns or []) if c in df.columns]
    if not cols:
        return df
    qd, q = bind_scalar(df, _quartiles(df, cols, accuracy), "_q")
    x = {c: nan_to_null(qcol(c).try_cast("double")) for c in cols}
    parts = []
    for c in cols:
        inside = x[c].between(q.getField(c)[0], q.getField(c)[1])
        xc = F.when(inside, x[c])
        has_central = F.count(xc) > 0
        parts.append(F.struct(
            F.when(has_central, F.avg(xc)).otherwise(F.avg(x[c])).alias("mu"),
            F.when(has_central, F.stddev_pop(xc)).otherwise(F.stddev_pop(x[c])).alias("sd")).alias(c))
    base, mom = bind_scalar(df, qd.agg(F.struct(*parts)).scalar(), "_m")
    flags = []
    for c in cols:
        mu, sd = mom.getField(c).getField("mu"), mom.getField(c).getField("sd")
        z = (x[c] - mu) / sd
        flag = F.when(sd.isNull() | (sd == 0), F.lit(False)).otherwise(F.coalesce(F.abs(z) > F.lit(threshold),
                                                                                  F.lit(False)))
        flags.append(flag.alias(prefix + c))
    return base.select(*[qcol(c) for c in df.columns], *flags)


__all__ = ["check_duplicates", "drop_duplicates", "check_missing", "check_types", "outliers_iqr",
           "outliers_zscore"]
