"""Row-position helpers that stay distributed.

A dense 0-based position in a total order without a single-partition window:
sort (range-partitioned), tag each row with its partition id and in-partition
ordinal, count rows per partition (a tiny table: one row per partition), turn
the counts into offsets, and add the offset back.  The sorted frame is
checkpointed into the shared folder first so both passes see identical
partitions even after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage

_LOW33 = (1 << 33) - 1


def with_row_index(df: DataFrame, order_by: list[str | Column], name: str = "row_idx",
                   checkpoint: bool = True) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_by`` order
    (ties broken by every column, so the index is deterministic)."""
    keys = [qcol(c) if isinstance(c, str) else c for c in order_by]
    tie = [qcol(c) for c in df.columns]
    srt = df.orderBy(*keys, *tie)
    tagged = srt.select("*", F.spark_partition_id().alias("_pid"),
                        F.monotonically_increasing_id().alias("_mid"))
    if checkpoint:
        tagged = cut_lineage(tagged)
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # offsets over at most #partitions rows
    offs = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off"))
    out = tagged.join(F.broadcast(offs), "_pid")
    idx = F.coalesce(F.col("_off"), F.lit(0)) + F.col("_mid").bitwiseAND(F.lit(_LOW33))
    return out.select(*[qcol(c) for c in df.columns], idx.cast("long").alias(name))
