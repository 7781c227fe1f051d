"""Categorical encoding.

The set of output columns of a one-hot encoding depends on the data, so the
distinct categories are the one thing brought to the driver: each becomes a
column.  ``max_categories``, where given, bounds them per column and is checked
before collecting.  Label codes never
leave the cluster: codes are the position of each category in sorted order
(distributed row index), joined back by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol, string_columns
from ..functions.rows import with_row_index


#: Label codes of a column go to every executor up to so many; beyond, the column is joined by value.
MANY_CODES = 100_000


class TooManyCategories(ValueError):
    pass


def _categorical_columns(df: DataFrame, columns=None) -> list[str]:
    cols = columns if columns is not None else string_columns(df)
    return [c for c in cols if c in df.columns and "date" not in c.lower() and "time" not in c.lower()]


def distinct_values(df: DataFrame, cols: list[str], max_categories: int | None = None) -> dict[str, list]:
    """Sorted distinct non-null values per column (one unpivot + distinct).  They
    become columns, so they must come to the driver; with ``max_categories`` a
    column that has more raises before they do."""
    if not cols:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), qcol(c).cast("string").alias("v")) for c in cols])
    vals = df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()
    # one capped fetch: if more than cap·k pairs exist, some column must exceed
    # the cap (pigeonhole), so nothing beyond the bound is ever transferred
    cap = max_categories * len(cols) if max_categories is not None else None
    rows = (vals if cap is None else vals.limit(cap + 1)).collect()
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        out[r["c"]].append(r["v"])
    over = {c: len(v) for c, v in out.items() if cap is not None and len(v) > max_categories}
    if over or cap is not None and len(rows) > cap:
        raise TooManyCategories(f"too many categories to one-hot encode: {over or 'over the total cap'} "
                                f"(cap {max_categories} per column)")
    return {c: sorted(v) for c, v in out.items()}


def _dummies(df: DataFrame, cats: dict[str, list], as_float: bool, sep: str = "_") -> DataFrame:
    keep = [qcol(c) for c in df.columns if c not in cats]
    new: list[Column] = []
    for c, values in cats.items():
        x = qcol(c).cast("string")
        for v in values:
            flag = F.coalesce(x == F.lit(v), F.lit(False))
            new.append((flag.cast("double") if as_float else flag).alias(f"{c}{sep}{v}"))
    return df.select(*keep, *new)


def one_hot(df: DataFrame, columns=None, max_categories: int | None = None) -> DataFrame:
    """Text columns (names containing "date"/"time" excluded) replaced by
    ``<col>_<value>`` columns of 0.0/1.0 in sorted value order; NULL -> all 0."""
    cols = _categorical_columns(df, columns)
    if not cols:
        return df
    return _dummies(df, distinct_values(df, cols, max_categories), as_float=True)


def label_encode(df: DataFrame, columns=None) -> DataFrame:
    """Each text column replaced by the 0-based rank of its value among the
    sorted distinct values; NULL -> -1."""
    cols = _categorical_columns(df, columns)
    out = df
    for c in cols:
        cats = out.select(qcol(c).cast("string").alias("_v")).where(F.col("_v").isNotNull()).distinct()
        codes = with_row_index(cats, ["_v"], "_code")
        if codes.limit(MANY_CODES + 1).count() <= MANY_CODES:       # a join by a few values would put all rows of one into one task
            codes = F.broadcast(codes)
        out = (out.join(codes, qcol(c).cast("string") == F.col("_v"), "left")
                  .withColumn(c, F.coalesce(F.col("_code"), F.lit(-1)).cast("int"))
                  .drop("_v", "_code"))
    return out


def smart_encode(df: DataFrame, cfg: dict | None = None) -> tuple[DataFrame, list[str]]:
    """One-hot only the text columns with 1 < distinct <= ``max_onehot_unique``
    (default 10), except ``exclude_onehot``; boolean dummies.  Returns
    (frame, encoded columns).

    Distinct counts: one approximate pass (HyperLogLog) rules out columns far
    above the bound; only the remaining candidates get an exact count."""
    cfg = cfg or {}
    max_u = int(cfg.get("max_onehot_unique", 10))
    exclude = set(cfg.get("exclude_onehot") or [])
    if cfg.get("coerce_list_columns_to_strings", True):
        df = list_to_json(df)
    cols = [c for c in string_columns(df) if c not in exclude]
    if not cols:
        return df, []
    approx = df.agg(*[F.approx_count_distinct(qcol(c), 0.05).alias(c) for c in cols]).collect()[0]
    maybe = [c for c in cols if approx[c] <= 4 * max_u]
    if not maybe:
        return df, []
    exact = df.agg(*[F.count_distinct(qcol(c)).alias(c) for c in maybe]).collect()[0]
    chosen = [c for c in maybe if 1 < exact[c] <= max_u]
    if not chosen:
        return df, []
    cats = distinct_values(df, chosen, max_u)
    return _dummies(df, cats, as_float=False), chosen


def _sorted_json_value(c: Column, dt: T.DataType) -> Column:
    """Re-shape a value so ``to_json`` writes object keys in sorted order."""
    if isinstance(dt, T.StructType):
        return F.struct(*[_sorted_json_value(c.getField(f.name), f.dataType).alias(f.name)
                          for f in sorted(dt.fields, key=lambda f: f.name)])
    if isinstance(dt, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(c)))
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.StructType, T.MapType)):
        return F.transform(c, lambda e: _sorted_json_value(e, dt.elementType))
    return c


def list_to_json(df: DataFrame) -> DataFrame:
    """Array / map / struct cells become JSON text (keys sorted, non-ASCII kept).
    Detected from the declared type, not by sampling values."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(_sorted_json_value(qcol(f.name), f.dataType)).alias(f.name))
        else:
            out.append(qcol(f.name))
    return df.select(*out)
