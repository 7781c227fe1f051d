"""Joins and history on tables stored by customer: rows are read where they lie, none is shuffled.

``store_by_key`` writes two tables: rows of ordinary keys bucketed by the key, rows of hot keys bucketed by (key, slice).
A key is hot if it alone holds more than a bucket's fair share, so there are fewer hot keys than buckets, whatever the
data; null counts as hot.  Their rows are range-partitioned in history order once, at the write, and each range is a
slice.  Later reads find every bucket within one task's reach:

* a join with a table bucketed alike is bucket by bucket; hot keys meet a broadcast of their few rows (one per key);
* running history of an ordinary key is a window inside its bucket; of a hot key a window inside each slice plus the
  totals of the slices before it, a table of at most two rows per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from ..sources.tables import save_table

SLICE = "_slice"


@dataclass(frozen=True)
class Stored:
    """Names of the two tables, the key and the history order."""

    cold: str
    hot: str
    key: str
    order: tuple[str, ...]
    columns: tuple[str, ...]


def store_by_key(df: DataFrame, name: str, key: str, order: list[str], buckets: int = 200, path: str | None = None) -> Stored:
    """Writes ``<name>`` and ``<name>_hot``.

    ``order`` is the history order; equal rows in it keep an order that is fixed at the write.  ``path``: external
    tables below that folder.
    """
    spark = df.sparkSession
    counts = cut_lineage(df.groupBy(qcol(key).alias("_k")).agg(F.count("*").alias("_n")))
    n = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = cut_lineage(counts.where((F.col("_n") > n / buckets) | F.col("_k").isNull()).select("_k"))    # ``buckets`` keys at most
    at = lambda t: f"{path}/{t}" if path else None
    is_hot = qcol(key).eqNullSafe(F.col("_k"))
    cold = df.join(F.broadcast(hot), is_hot, "left_anti").repartition(buckets, qcol(key))     # one task, one file a bucket
    save_table(cold, name, "replace", bucket_by=(buckets, [key]), path=at(name))
    keys = [qcol(key).asc_nulls_first(), *[qcol(c).asc_nulls_first() for c in order]]
    rows = df.join(F.broadcast(hot), is_hot, "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    sliced = rows.repartitionByRange(buckets, *keys, F.col("_tie").asc()).withColumn(SLICE, F.spark_partition_id())
    save_table(sliced, f"{name}_hot", "replace", bucket_by=(buckets, [key, SLICE]), path=at(f"{name}_hot"))
    return Stored(name, f"{name}_hot", key, tuple(order), tuple(df.columns))


def store_dimension(df: DataFrame, name: str, key: str, buckets: int = 200, path: str | None = None) -> str:
    """A table to join with, bucketed alike."""
    save_table(df, name, "replace", bucket_by=(buckets, [key]), path=f"{path}/{name}" if path else None)
    return name


def join_stored(spark: SparkSession, fact: Stored, dimension: str, columns: list[str]) -> DataFrame:
    """Inner join on the key; ``columns`` of the dimension are added to those of the fact table.

    The dimension's rows for hot keys are found in its buckets and broadcast: one row per key and copy in it.
    """
    dim = spark.table(dimension).select(qcol(fact.key), *[qcol(c) for c in columns])
    cold = spark.table(fact.cold).join(dim, fact.key)
    hot = spark.table(fact.hot)
    few = cut_lineage(dim.join(F.broadcast(cut_lineage(hot.select(qcol(fact.key)).distinct())), fact.key, "left_semi"))
    out = [qcol(c) for c in (*fact.columns, *columns)]
    return cold.select(*out).unionByName(hot.join(F.broadcast(few), fact.key).select(*out))


def stored_history(spark: SparkSession, fact: Stored, amount_col: str = "amount") -> DataFrame:
    """F3 + F4: ``_cnt_prev`` and ``_amount_prev_mean`` per row, as ``history_features`` has them, without a shuffle of rows."""
    a, order = qcol(amount_col).cast("double"), [qcol(c).asc_nulls_first() for c in fact.order]
    cols = [qcol(c) for c in fact.columns]

    def before(w: Window) -> list:
        return [F.count(F.lit(1)).over(w).alias("_n"), F.coalesce(F.sum(a).over(w), F.lit(0.0)).alias("_s"), F.count(a).over(w).alias("_nn")]

    w = Window.partitionBy(fact.key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cold = spark.table(fact.cold).select(*cols, *before(w))
    hot = spark.table(fact.hot)
    none = hot.where(qcol(fact.key).isNull()).select(*cols, F.lit(0).cast("long").alias("_n"), F.lit(0.0).alias("_s"), F.lit(0).cast("long").alias("_nn"))
    hot = hot.where(qcol(fact.key).isNotNull())
    blocks = cut_lineage(hot.groupBy(fact.key, SLICE).agg(F.count("*").alias("_bn"), F.sum(a).alias("_bs"), F.count(a).alias("_bnn")))
    upto = Window.partitionBy(fact.key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select(fact.key, SLICE, *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_o{c}") for c in ("_bn", "_bs", "_bnn")])
    inside = Window.partitionBy(fact.key, SLICE).orderBy(*order, F.col("_tie")).rowsBetween(Window.unboundedPreceding, -1)
    sliced = hot.select(*cols, SLICE, *before(inside)).join(F.broadcast(cut_lineage(base)), [fact.key, SLICE])
    hot = sliced.select(*cols, (F.col("_n") + F.col("_o_bn")).alias("_n"), (F.col("_s") + F.col("_o_bs")).alias("_s"), (F.col("_nn") + F.col("_o_bnn")).alias("_nn"))
    return cold.unionByName(none).unionByName(hot).select(
        *cols, F.col("_n").alias("_cnt_prev"), F.coalesce(F.try_divide("_s", "_nn"), F.lit(0.0)).alias("_amount_prev_mean"))
