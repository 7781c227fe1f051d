"""Cleaning and type coercion.

Bad values become NULL (``try_*`` casts; ANSI mode would otherwise raise).
Column statistics needed by a transform (fill values, means, ranges) are one
aggregation pass that enters the row-level plan as a scalar subquery.  The only
values brought to the driver are schema-deciding: the per-column null ratio
that decides which columns to drop (one number per column).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import DEFAULT_DATE_FORMATS, bind_scalar, is_numeric, nan_to_null, numeric_columns, qcol, to_datetime
from ..functions.quantiles import quantile_table
from .profile import duplicate_rows

# Key columns coerced and reported by the cleaning stage.
ID_INT_COLUMNS = ("order_id", "customer_id")
KEY_COLUMNS = ("order_id", "customer_id", "order_date", "amount", "country")

def to_integer(c: Column) -> Column:
    """Numeric coercion to BIGINT; text that is not a number, and fractional
    values, become NULL."""
    # whole numbers as they are written: no way through DOUBLE, which holds 53 bits only
    exact = c.cast("string").try_cast("bigint")
    d = nan_to_null(c.try_cast("double"))
    return F.coalesce(exact, F.when(d == F.floor(d), d.try_cast("bigint")))


def to_double(c: Column) -> Column:
    return nan_to_null(c.try_cast("double"))


def coerce_types(df: DataFrame) -> DataFrame:
    """Ids -> BIGINT, amount -> DOUBLE, order_date -> timestamp; bad -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in ID_INT_COLUMNS:
            out.append(to_integer(qcol(c)).alias(c))
        elif c == "amount":
            out.append(to_double(qcol(c)).alias(c))
        elif c == "order_date":
            out.append(to_datetime(qcol(c), types[c]).alias(c))
        else:
            out.append(qcol(c))
    return df.select(*out)


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Rows and missing values per column (NaN counts as missing), one pass;
    one number per column reaches the driver."""
    exprs = [F.count(F.lit(1)).alias("_n")]
    for f in df.schema.fields:
        c = qcol(f.name)
        miss = c.isNull() | F.isnan(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c.isNull()
        exprs.append(F.count_if(miss).alias(f.name))
    row = df.agg(*exprs).collect()[0]
    return row["_n"], {c: row[c] for c in df.columns}


def null_ratios(df: DataFrame) -> dict[str, float]:
    """Share of missing values per column (NaN counts as missing)."""
    if not df.columns:
        return {}
    n, miss = null_counts(df)
    return {c: (miss[c] / n if n else 0.0) for c in df.columns}


def drop_high_missing(df: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null ratio is strictly above ``threshold``."""
    ratios = null_ratios(df)
    dropped = [c for c in df.columns if ratios.get(c, 0.0) > threshold]
    return (df.drop(*dropped) if dropped else df), dropped


def missing_counts(df: DataFrame, columns=None) -> DataFrame:
    """C4 / V3 core: (column, missing) for the listed columns that exist, one pass."""
    cols = [c for c in (columns or df.columns) if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, missing long")
    fields = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for c in cols:
        x = qcol(c)
        miss = x.isNull() | F.isnan(x) if isinstance(fields[c], (T.FloatType, T.DoubleType)) else x.isNull()
        cells.append(F.struct(F.lit(c).alias("column"), F.count_if(miss).cast("long").alias("missing")))
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


@dataclass
class CleaningResult:
    df: DataFrame
    dropped: list[str]
    stats: DataFrame          # one row: sales_duplicates + missing_<key> per surviving key
    missing: DataFrame = field(default=None)  # long form (column, missing)


def run_cleaning(df: DataFrame, cfg: dict | None = None) -> CleaningResult:
    """Coerce types -> drop mostly-empty columns -> count duplicate rows and
    missing key values.  Duplicates are counted, not removed."""
    cfg = cfg or {}
    thr = float((((cfg.get("processing") or {}).get("cleaner") or {}).get("drop_high_missing_columns") or {})
                .get("threshold", 0.8))
    typed = coerce_types(df)
    if cfg.get("cache", False):
        typed = typed.persist()
    # one pass gives both the drop decision and the missing counts of the keys
    n, nulls = null_counts(typed) if typed.columns else (0, {})
    dropped = [c for c in typed.columns if n and nulls[c] / n > thr]
    clean = typed.drop(*dropped) if dropped else typed
    keys = [c for c in KEY_COLUMNS if c in clean.columns]
    miss = missing_counts(clean, keys)
    stats = duplicate_rows(clean).select(
        F.col("duplicates").alias("sales_duplicates"),
        *[F.lit(nulls[c]).cast("long").alias(f"missing_{c}") for c in keys])
    return CleaningResult(df=clean, dropped=dropped, stats=stats, missing=miss)


def parse_dates(df: DataFrame, columns, formats=DEFAULT_DATE_FORMATS) -> DataFrame:
    """Listed (existing) columns to timestamps; bad values -> NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = set(c for c in (columns or []) if c in types)
    return df.select(*[to_datetime(qcol(c), types[c], formats).alias(c) if c in cols else qcol(c)
                       for c in df.columns])


def _mode_values(df: DataFrame, cols: list[str]) -> Column:
    """Scalar struct of the most frequent non-null value per column (ties -> the
    smallest), computed by one unpivot + two shuffles with map-side combining;
    no group is ever collected into one task."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), qcol(c).cast("string").alias("v")) for c in cols])
    cnt = (df.select(F.inline(pairs)).where(F.col("v").isNotNull())
             .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    best = cnt.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("v").alias("v"))).alias("b"))
    one_row = best.agg(F.struct(*[F.max(F.when(F.col("c") == c, F.col("b.v"))).alias(c) for c in cols]))
    return one_row.scalar()


def impute(df: DataFrame, strategy: str = "median", accuracy: int | None = None,
           cat_strategy: str = "most_frequent") -> DataFrame:
    """C7 + C8: numeric columns filled with their median (or mean); every other
    column with its most frequent value; an all-null text column gets "".
    (``cat_strategy`` is accepted for compatibility; only the mode is used.)"""
    fields = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in df.columns if is_numeric(fields[c])]
    other = [c for c in df.columns if c not in num]
    # whole numbers with gaps become DOUBLE, since their mean or median may be fractional; without gaps they stay
    whole = [c for c in num if not isinstance(fields[c], (T.FloatType, T.DoubleType))]
    gaps = null_counts(df.select(*[qcol(c) for c in whole]))[1] if whole else {}
    widened = {c for c in whole if gaps[c]}
    fills = {}
    base = df
    if num:
        if strategy == "mean":
            st_expr = df.agg(F.struct(*[F.avg(nan_to_null(qcol(c).cast("double"))).alias(c) for c in num])).scalar()
        else:
            qt = quantile_table(df, num, [0.5], method="approx" if accuracy else "auto", accuracy=accuracy or 10_000)
            st_expr = qt.select(F.struct(*[qcol(c)[0].alias(c) for c in num])).scalar()
        base, st = bind_scalar(base, st_expr, "_fill_num")
        for c in num:
            fills[c] = st.getField(c) if c in widened else st.getField(c).cast(fields[c])
    if other:
        base, modes = bind_scalar(base, _mode_values(df, other), "_fill_mode")
        for c in other:
            v = modes.getField(c)
            if isinstance(fields[c], T.StringType):
                fills[c] = F.coalesce(v, F.lit(""))
            else:
                fills[c] = v.try_cast(fields[c])
    out = []
    for c in df.columns:
        x = nan_to_null(qcol(c)) if isinstance(fields[c], (T.FloatType, T.DoubleType)) else qcol(c)
        x = x.cast("double") if c in widened else x
        out.append(F.coalesce(x, fills[c]).alias(c) if c in fills else qcol(c))
    return base.select(*out)


def scale(df: DataFrame, method: str = "standard", columns=None) -> DataFrame:
    """Standard (population std; zero std -> divide by 1) or min-max
    (constant column -> 0) scaling of the numeric columns; NULL stays NULL."""
    cols = columns or numeric_columns(df)
    if not cols:
        return df
    x = {c: nan_to_null(qcol(c).cast("double")) for c in cols}
    if method == "minmax":
        st_expr = df.agg(F.struct(*[F.struct(F.min(x[c]).alias("a"), (F.max(x[c]) - F.min(x[c])).alias("b")).alias(c)
                               for c in cols])).scalar()
    else:
        st_expr = df.agg(F.struct(*[F.struct(F.avg(x[c]).alias("a"), F.stddev_pop(x[c]).alias("b")).alias(c)
                                    for c in cols])).scalar()
    base, st = bind_scalar(df, st_expr)
    out = []
    for c in df.columns:
        if c in cols:
            a, b = st.getField(c).getField("a"), st.getField(c).getField("b")
            den = F.coalesce(F.nullif(b, F.lit(0.0)), F.lit(1.0))
            out.append(((x[c] - a) / den).alias(c))
        else:
            out.append(qcol(c))
    return base.select(*out)
