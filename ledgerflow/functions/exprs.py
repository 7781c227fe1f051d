"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Identifier columns never treated as numeric measures.
ID_COLUMNS = ("order_id", "customer_id")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    """Numeric in the pandas ``select_dtypes(np.number)`` sense: booleans excluded."""
    return isinstance(dt, _NUMERIC)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def qcol(name: str) -> Column:
    """Column reference that tolerates dots and other specials in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


# Date formats tried in order.
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
                        "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                        "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss")


def to_datetime(c: Column, dtype: T.DataType, formats=DEFAULT_DATE_FORMATS) -> Column:
    """Timestamp (no time zone) from a date, timestamp or text column; text that
    matches none of ``formats`` becomes NULL."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    s = F.trim(c.cast("string"))
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])
    return parsed.cast("timestamp_ntz")


def day_of(df: DataFrame, name: str) -> Column:
    """Calendar day of a date, timestamp or text column; text that is no date gives NULL."""
    return F.to_date(to_datetime(qcol(name), df.schema[name].dataType))


def nan_to_null(c: Column) -> Column:
    """Spark keeps NaN distinct from NULL; the reference treats both as missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_pearson(a: Column, b: Column) -> Column:
    """Pearson correlation over pairwise-complete rows; NULL when either side has
    zero variance (bare ``corr`` raises DIVIDE_BY_ZERO under ANSI)."""
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))


def bin_edges(mn: Column, mx: Column, bins: int) -> tuple[Column, Column]:
    """(lo, width) of ``bins`` equal-width bins over [mn, mx]; a constant column
    is widened to [mn - 0.5, mx + 0.5] (numpy's histogram rule)."""
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    return lo, (hi - lo) / F.lit(bins)


def bin_index(x: Column, lo: Column, width: Column, bins: int) -> Column:
    """1-based bin of x given precomputed (lo, width); the right edge belongs to
    the last bin.  Kept small: it is evaluated per row."""
    return F.least(F.floor((x - lo) / width) + 1, F.lit(bins)).cast("int")


def split_flag(key: Column, seed: int = 42, test_fraction: float = 0.25) -> Column:
    """Deterministic hash split: True for the held-out part.

    ``md5(seed || key)`` prefix compared with the fraction of the 32-bit range; it
    depends only on the key, so it is stable under repartitioning and identical in
    any engine with md5.
    """
    bound = format(int(test_fraction * 0x100000000), "08x")
    h = F.substring(F.md5(F.concat(F.lit(str(seed)), key.cast("string"))), 1, 8)
    return h < F.lit(bound)


def row_key(df: DataFrame) -> Column:
    """Text that is never NULL and tells different rows apart (equal rows share it)."""
    return F.coalesce(F.to_json(F.struct(*[qcol(c) for c in df.columns])), F.lit(""))


def bind_scalar(df: DataFrame, scalar: Column, name: str = "_st") -> tuple[DataFrame, Column]:
    """Attach a scalar subquery as one column and return a reference to it.

    Every textual use of a ``DataFrame.scalar()`` expression becomes its own
    subquery (its own job); binding it once as a column makes it one subquery
    however many expressions read it.  Drop ``name`` when done."""
    return df.select("*", scalar.alias(name)), F.col(name)
