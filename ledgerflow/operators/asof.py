"""As-of join: every row with the last row of another table that its key had at that time.

Both tables are strung together and range-partitioned by (key, time), so a key with a third of all rows fills many
partitions.  Inside a partition the last right row before each left row is a running value per key.  A key that goes on
in the next partition takes its last right row along: those carried rows are a table of at most two rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: list[str], allow_equal: bool = True,
              partitions: int | None = None) -> DataFrame:
    """``left`` with ``right_time`` and ``columns`` of the last right row of the same key at or before (``allow_equal``) its time.

    Of right rows at one time the one with the greatest values counts.  Left rows without such a row, with a null
    key or a null time get nulls; right rows with a null key or time are never found.  Names that ``left`` has already
    come with a ``_right`` behind them.
    """
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    taken = [c for c in dict.fromkeys([right_time, *columns])]
    payload = F.struct(*[qcol(c).alias(f"v{i}") for i, c in enumerate(taken)])
    # at one time, right rows stand before left rows if they count for them
    l = left.select(qcol(key).alias("k"), qcol(left_time).alias("t"), F.lit(1 if allow_equal else 0).alias("side"),  # noqa: E741
                    F.struct(*[qcol(c).alias(f"c{i}") for i, c in enumerate(left.columns)]).alias("row"))
    r = (right.where(qcol(key).isNotNull() & qcol(right_time).isNotNull())
         .select(qcol(key).alias("k"), qcol(right_time).alias("t"), F.lit(0 if allow_equal else 1).alias("side"), payload.alias("p")))
    both = l.where("k is not null and t is not null").unionByName(r, allowMissingColumns=True).withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("t"), F.col("side"), F.col("p").asc_nulls_first(), F.col("tie")]
    ranged = cut_lineage(both.repartitionByRange(n, "k", *order).withColumn("pid", F.spark_partition_id()))

    ends = ranged.groupBy("k", "pid").agg(F.max_by("p", F.when(F.col("p").isNotNull(), F.struct("t", "p"))).alias("p"))
    many = ends.groupBy("k").agg(F.min("pid").alias("lo"), F.max("pid").alias("hi")).where("lo < hi").select("k")      # at most one key per border
    carried = ends.join(F.broadcast(cut_lineage(many)), "k").select(
        "k", "pid", F.last("p", ignorenulls=True).over(Window.partitionBy("k").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    inside = Window.partitionBy("pid", "k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (ranged.withColumn("got", F.last("p", ignorenulls=True).over(inside)).where("row is not null")
             .join(F.broadcast(cut_lineage(carried)), ["k", "pid"], "left").select("row", F.coalesce("got", "before").alias("got")))
    loose = l.where("k is null or t is null").select("row", F.lit(None).cast(r.schema["p"].dataType).alias("got"))
    used, out = {c.lower() for c in left.columns}, []
    for i, c in enumerate(taken):
        name = c
        while name.lower() in used:
            name += "_right"
        used.add(name.lower())
        out.append(F.col("got")[f"v{i}"].alias(name))
    return found.unionByName(loose).select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(left.columns)], *out)
