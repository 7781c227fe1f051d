"""Skew-safe running aggregates per key ("everything before this row in my group").

A plain ``Window.partitionBy(key).orderBy(...)`` sorts each key in one task, so
a key holding a third of all rows would land in a single task.  Instead:

1. range-partition the rows by (key, order columns, tie-breaker): the range
   partitioner splits a hot key across many partitions;
2. aggregate each (partition, key) block — a small table, at most
   #partitions rows for any one key — and prefix-sum the blocks per key;
3. run the within-block running aggregates with a window over
   (partition, key), whose groups are bounded by the partition size, and add
   the block offsets.

Identical rows are ordered by a tie-breaker id; which copy comes first does not
change the multiset of results.  Partition ids and tie-breakers are pinned by a
reliable checkpoint (shared folder), because the frame is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage


def prefix_by_key(df: DataFrame, key: str, order_by: list[str], value: str | list[str] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Add ``_prev_n`` (rows before this one in the key group), ``_key_n`` (rows
    in the key group, summed from the block table), and with
    ``value`` also ``_prev_sum`` / ``_prev_nn`` (sum and count of the earlier
    non-null values; for a list of columns ``_prev_sum_<c>`` / ``_prev_nn_<c>``).
    Rows with a NULL key get NULLs."""
    values = {"": value} if isinstance(value, str) else {f"_{c}": c for c in value or []}
    spark = df.sparkSession
    nparts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [qcol(c).asc_nulls_first() for c in order_by]
    t = df.withColumn("_key", qcol(key)).withColumn("_tb", F.monotonically_increasing_id())
    ranged = t.repartitionByRange(nparts, F.col("_key").asc(), *order, F.col("_tb").asc())
    # Pin partition ids and tie-breakers: the frame is read twice below (block
    # totals and rows), so it is checkpointed into the shared folder once.
    ranged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id()))

    v = {k: qcol(c).cast("double") for k, c in values.items()}
    block_aggs = [F.count(F.lit(1)).alias("_bn")]
    for k, x in v.items():
        block_aggs += [F.sum(x).alias(f"_bs{k}"), F.count(x).alias(f"_bnn{k}")]
    blocks = ranged.where(F.col("_key").isNotNull()).groupBy("_key", "_pid").agg(*block_aggs)
    before = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"),
            F.sum("_bn").over(Window.partitionBy("_key")).alias("_kn")]
    for k in v:
        offs += [F.coalesce(F.sum(qcol(f"_bs{k}")).over(before), F.lit(0.0)).alias(f"_os{k}"),
                 F.coalesce(F.sum(qcol(f"_bnn{k}")).over(before), F.lit(0)).alias(f"_onn{k}")]
    offsets = blocks.select("_key", "_pid", *offs)

    w = (Window.partitionBy("_pid", "_key").orderBy(*order, F.col("_tb").asc())
               .rowsBetween(Window.unboundedPreceding, -1))
    cols: list[Column] = [qcol(c) for c in df.columns]
    j = ranged.join(offsets, ["_key", "_pid"], "left")      # rows with a NULL key find no block: NULLs
    out = [*cols, (F.col("_on") + F.coalesce(F.count(F.lit(1)).over(w), F.lit(0))).cast("long").alias("_prev_n"),
           F.col("_kn").cast("long").alias("_key_n")]
    for k, x in v.items():
        out += [(qcol(f"_os{k}") + F.coalesce(F.sum(x).over(w), F.lit(0.0))).alias(f"_prev_sum{k}"),
                (qcol(f"_onn{k}") + F.coalesce(F.count(x).over(w), F.lit(0))).cast("long").alias(f"_prev_nn{k}")]
    return j.select(*out)
