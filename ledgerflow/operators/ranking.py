"""row_number, rank, dense_rank, ntile, lag and lead over groups of any size.

A window sorts each group in one task.  Here rows get their number from running counts over range partitions
(``prefix_by_key``), which split a hot group; ranks come from running sums over the runs of equal order values, a table
that is aggregated map-side before anything moves; neighbours are found by an equi-join on (group, number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..functions.prefix import prefix_by_key
from ..session import cut_lineage


def numbered(df: DataFrame, key: str, order_by: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``row_number`` (from 1) and ``group_rows`` within ``key``, nulls first; equal rows in any order.

    Rows with a null key have a null number.
    """
    p = prefix_by_key(df, key, order_by, partitions=partitions)
    return p.select(*[qcol(c) for c in df.columns], (F.col("_prev_n") + 1).alias("row_number"), F.col("_key_n").alias("group_rows"))


def ranked(df: DataFrame, key: str, order_by: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``rank`` and ``dense_rank`` within ``key``: rows before the run of equal order values, and runs before it, plus one."""
    names = [f"_o{i}" for i in range(len(order_by))]
    runs = df.where(qcol(key).isNotNull()).groupBy(qcol(key).alias("_k"), *[qcol(c).alias(n) for c, n in zip(order_by, names)]).agg(F.count("*").alias("_n"))
    p = prefix_by_key(runs, "_k", names, "_n", partitions)
    p = p.select("_k", *names, (F.col("_prev_sum").cast("long") + 1).alias("rank"), (F.col("_prev_n") + 1).alias("dense_rank"))
    same = qcol(key) == F.col("_k")
    for c, n in zip(order_by, names):
        same = same & qcol(c).eqNullSafe(F.col(n))
    return df.join(p, same, "left").select(*[qcol(c) for c in df.columns], "rank", "dense_rank")


def ntiles(df: DataFrame, key: str, order_by: list[str], tiles: int, partitions: int | None = None) -> DataFrame:
    """``df`` with ``ntile``: the group cut into ``tiles`` parts of equal size, the first ones a row longer where it doesn't divide."""
    n = numbered(df, key, order_by, partitions)
    size, more, at = F.floor(F.col("group_rows") / tiles), F.col("group_rows") % tiles, F.col("row_number") - 1
    edge = more * (size + 1)                                 # rows in the longer tiles
    tile = F.when(at < edge, F.floor(at / (size + 1))).otherwise(more + F.floor((at - edge) / F.greatest(size, F.lit(1))))
    return n.select(*[qcol(c) for c in df.columns], (tile + 1).cast("int").alias("ntile"))


def shifted(df: DataFrame, key: str, order_by: list[str], value: str, offset: int = 1, name: str = "lag", partitions: int | None = None) -> DataFrame:
    """``df`` with the ``value`` of the row ``offset`` places before (lag) or, if negative, behind (lead) in its group; null where there is none."""
    n = cut_lineage(numbered(df, key, order_by, partitions))         # read twice: its order is fixed here
    other = n.where("row_number is not null").select(qcol(key).alias("_k"), (F.col("row_number") + offset).alias("_at"), qcol(value).alias("_v"))
    got = n.join(other, (qcol(key) == F.col("_k")) & (F.col("row_number") == F.col("_at")), "left")
    return got.select(*[qcol(c) for c in df.columns], F.col("_v").alias(name))
