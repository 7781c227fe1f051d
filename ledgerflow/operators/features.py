"""Features for the models.

"Previous orders of this customer" follows an explicit order (order_date,
order_id, source) — the reference used stacking order — and runs as a
skew-safe prefix aggregation (``functions.prefix``), not a per-customer window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ID_COLUMNS, bind_scalar, day_of, is_numeric, nan_to_null, qcol, row_key, split_flag
from ..functions.quantiles import quantile_table
from ..functions.prefix import prefix_by_key
from .encode import distinct_values

# The history order used for per-customer features.
HISTORY_ORDER = ("order_date", "order_id", "source")


def calendar_features(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """dow (Monday = 0), month, is_weekend (dow >= 5); missing dates -> 0."""
    if date_col not in df.columns:
        return df
    d = day_of(df, date_col)
    dow = F.weekday(d)
    return df.select("*", F.coalesce(dow, F.lit(0)).cast("long").alias("dow"),
                     F.coalesce(F.month(d), F.lit(0)).cast("long").alias("month"),
                     F.coalesce((dow >= 5).cast("long"), F.lit(0)).alias("is_weekend"))


def source_dummies(df: DataFrame, source_col: str = "source", prefix: str = "src",
                   max_categories: int | None = None) -> DataFrame:
    """``src_<value>`` boolean columns (sorted values) replacing the source column."""
    if source_col not in df.columns:
        return df
    values = distinct_values(df, [source_col], max_categories)[source_col]
    x = qcol(source_col).cast("string")
    keep = [qcol(c) for c in df.columns if c != source_col]
    return df.select(*keep, *[F.coalesce(x == F.lit(v), F.lit(False)).alias(f"{prefix}_{v}") for v in values])


def history_features(df: DataFrame, key: str = "customer_id", amount_col: str = "amount",
                     order_by: tuple[str, ...] = HISTORY_ORDER) -> DataFrame:
    """F3 + F4: ``_cnt_prev`` = earlier orders of the customer, ``_amount_prev_mean``
    = mean of the earlier non-null amounts (current row excluded); no customer or
    no earlier amount -> 0."""
    if key not in df.columns:
        return df
    order = [c for c in order_by if c in df.columns]
    has_amount = amount_col in df.columns
    p = prefix_by_key(df, key, order, amount_col if has_amount else None)
    out = [qcol(c) for c in df.columns]
    out.append(F.coalesce(F.col("_prev_n"), F.lit(0)).alias("_cnt_prev"))
    if has_amount:
        out.append(F.coalesce(F.try_divide(F.col("_prev_sum"), F.col("_prev_nn")), F.lit(0.0)).alias("_amount_prev_mean"))
    return p.select(*out)


def build_features(df: DataFrame) -> DataFrame:
    """calendar + source dummies + customer history, ``order_id`` dropped."""
    x = calendar_features(df)
    x = history_features(x)
    x = source_dummies(x)
    return x.drop("order_id")


def classification_target(df: DataFrame, target: str | None = None, q: float = 0.8,
                          amount_col: str = "amount", accuracy: int | None = None) -> tuple[DataFrame, str]:
    """the given target column cast to int, else ``amount >= quantile(q)``
    as 0/1 (NULL amount -> 0), named ``high_value_qX.XX``."""
    if target and target in df.columns:
        return df.withColumn(target, qcol(target).cast("int")), target
    if amount_col not in df.columns:
        raise ValueError("No 'amount' column to derive classification target.")
    name = f"high_value_q{q:.2f}"
    a = nan_to_null(qcol(amount_col).cast("double"))
    qt = quantile_table(df, [amount_col], [q], method="approx" if accuracy else "auto", accuracy=accuracy or 10_000)
    base, thr = bind_scalar(df, qt.select(qcol(amount_col)[0]).scalar(), "_thr")
    return base.withColumn(name, F.coalesce(a >= thr, F.lit(False)).cast("int")).drop("_thr"), name


def numeric_feature_columns(df: DataFrame, drop: list[str]) -> list[str]:
    """F7 (schema part): numeric, non-ID columns not in ``drop``; booleans excluded."""
    return [f.name for f in df.schema.fields
            if f.name not in drop and f.name not in ID_COLUMNS and is_numeric(f.dataType)]


def select_numeric(df: DataFrame, drop: list[str]) -> tuple[DataFrame, list[str]]:
    """the numeric feature columns as DOUBLE with NULL -> 0.0."""
    cols = numeric_feature_columns(df, drop)
    return df.select(*[F.coalesce(nan_to_null(qcol(c).cast("double")), F.lit(0.0)).alias(c) for c in cols]), cols


def split(df: DataFrame, key: str | None, seed: int = 42, test_fraction: float = 0.25, flag: str = "is_test") -> DataFrame:
    """Deterministic hash split (depends on the key only, so it is the
    same under any partitioning and re-computation).  A NULL key, or ``key`` None,
    is replaced by the whole row, so that every row is in one of the parts."""
    k = F.coalesce(qcol(key).cast("string"), row_key(df)) if key else row_key(df)
    return df.withColumn(flag, split_flag(k, seed, test_fraction))


def split_stratified(df: DataFrame, label: str, key: str | None, seed: int = 42, test_fraction: float = 0.25,
                     flag: str = "is_test") -> DataFrame:
    """F8: exact per-class split.  Within each class the rows are ranked by the
    same md5 hash as ``split`` (then by key) and the first ceil(fraction · n_class)
    are held out.  Rank and class size both come from the skew-safe prefix count
    (a class is one huge group); no join on the label.  A NULL key, or ``key`` None,
    is replaced by the whole row."""
    k = F.coalesce(qcol(key).cast("string"), row_key(df)) if key else row_key(df)
    h = F.substring(F.md5(F.concat(F.lit(str(seed)), k)), 1, 8)
    x = df.withColumn("_h", h).withColumn("_lbl", qcol(label))
    ranked = prefix_by_key(x, "_lbl", ["_h", key] if key else ["_h"])      # also gives the class size (_key_n)
    held = F.col("_prev_n") < F.ceil(F.lit(test_fraction) * F.col("_key_n"))
    return ranked.select(*[qcol(c) for c in df.columns], F.coalesce(held, F.lit(False)).alias(flag))


__all__ = ["split_stratified", "calendar_features", "source_dummies", "history_features", "build_features", "classification_target",
           "numeric_feature_columns", "select_numeric", "split"]
