"""Landing of files that arrive in drops: every new file is read once, repeated rows are dropped, restarts go on.

A run takes the files that have come since the last one (``availableNow``) and ends.  Keys seen are streaming state that
the watermark on the event time bounds: a key's row is forgotten once the watermark is ``delay`` past it, and rows that
come when the watermark is past them are late and stay out.  Offsets, state and the list of files written live below
``checkpoint``, so a run that broke off is finished by the next one, without lost or doubled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol


@dataclass(frozen=True)
class Landed:
    """What a run did, over all its batches."""

    batches: int        # those that had files
    read: int           # rows of new files
    late: int           # rows behind the watermark
    repeated: int       # rows whose key was there within the delay


def deduplicated_stream(stream: DataFrame, time_col: str, keys: list[str], delay: str) -> DataFrame:
    """The stream without late rows and without repeats of ``keys`` within ``delay``.

    Rows without an event time belong to no place in time: they pass as they are.  Null keys are keys like any other.
    """
    timed = (stream.where(qcol(time_col).isNotNull()).withWatermark(time_col, delay)
             .dropDuplicatesWithinWatermark(keys))
    return timed.unionByName(stream.where(qcol(time_col).isNull()))


def land_files(spark: SparkSession, source: str, schema: T.StructType | str, target: str, checkpoint: str, time_col: str, keys: list[str],
               delay: str = "7 days", file_format: str = "csv", options: dict[str, str] | None = None, files_per_batch: int | None = None,
               partition_by: list[str] | None = None) -> Landed:
    """Appends the rows of the files below ``source`` that no earlier run has read to the Parquet table ``target``.

    ``files_per_batch`` bounds what a batch reads (all new files by default); ``partition_by`` lays the table out in
    folders.  The number of state partitions is that of the first run's shuffle partitions.
    """
    reader = spark.readStream.schema(schema).format(file_format).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = (deduplicated_stream(reader.load(source), time_col, keys, delay).writeStream.format("parquet").outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query, seen = writer.start(), {}
    while True:                                              # the query itself keeps its last 100 reports only
        ended = query.awaitTermination(1)
        seen |= {p["batchId"]: p for p in query.recentProgress if p["numInputRows"] or p["batchId"] not in seen}
        if ended:
            break
    state = [s for p in seen.values() for s in p["stateOperators"]]
    return Landed(sum(p["numInputRows"] > 0 for p in seen.values()), sum(p["numInputRows"] for p in seen.values()),
                  sum(s["numRowsDroppedByWatermark"] for s in state),
                  sum(s.get("customMetrics", {}).get("numDroppedDuplicateRows", 0) for s in state))


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The table as of the last finished batch."""
    return spark.read.parquet(target)


def daily_totals(rows: DataFrame, time_col: str, value_col: str, group_cols: list[str] | None = None) -> DataFrame:
    """(group..., day, rows, total) of a landed table; rows without a time have a null day."""
    by = [qcol(c) for c in group_cols or []]
    return rows.groupBy(*by, F.to_date(qcol(time_col)).alias("day")).agg(F.count("*").alias("rows"), F.sum(qcol(value_col)).alias("total"))
