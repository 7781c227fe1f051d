"""Table sinks (S7) and the key/value metric export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol

_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def save_table(df: DataFrame, table: str, if_exists: str = "append", jdbc: dict | None = None,
               bucket_by: tuple[int, list[str]] | None = None, path: str | None = None) -> None:
    """Append to / replace a catalog table, or — with ``jdbc`` options (url,
    user, ...) — a table in an external database through Spark's JDBC writer.

    ``bucket_by=(n, keys)`` stores the table hash-bucketed (and sorted) on
    ``keys``: later joins / aggregations on those keys between tables bucketed
    the same way read co-located data without a shuffle.  ``path`` makes it an
    external table in shared storage."""
    mode = _MODES.get(if_exists, if_exists)
    if jdbc:
        opts = dict(jdbc)
        url = opts.pop("url")
        df.write.mode(mode).jdbc(url, table, properties=opts)
        return
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    w.saveAsTable(table)


def metrics_to_kv(metrics: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """S9 core: wide metric rows -> (metric, value) text rows via ``unpivot``."""
    cols = columns or metrics.columns
    casted = metrics.select(*[qcol(c).cast("string").alias(c) for c in cols])
    return casted.unpivot([], cols, "metric", "value")


def export_metrics(sales: DataFrame, customers: DataFrame, table: str | None = None, k: int = 3) -> DataFrame:
    """Sales / customers counts and the top-k countries by joined order count
    as (metric, value) text rows; appended to ``table`` when given."""
    from ..operators.profile import table_counts, top_countries

    counts = metrics_to_kv(table_counts(sales, customers))
    top = top_countries(sales, customers, k).select(
        F.concat(F.lit("top_country_"), F.col("country")).alias("metric"), F.col("cnt").cast("string").alias("value"))
    out = counts.unionByName(top)
    if table:
        save_table(out, table, if_exists="append")
    return out


def export_metrics_run(sales: DataFrame, customers: DataFrame, path: str, run_id: str, k: int = 3) -> DataFrame:
    """S9 as one batch per run below ``path``: (metric, value, run_id) of all runs so far.

    A run that is repeated replaces its own batch and leaves the others alone, so nothing doubles; readers see a batch
    only when it is whole.
    """
    batch = export_metrics(sales, customers, k=k).withColumn("run_id", F.lit(run_id))
    batch.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)     # k + 2 rows
    return sales.sparkSession.read.schema(batch.schema).parquet(path).select("metric", "value", "run_id")
