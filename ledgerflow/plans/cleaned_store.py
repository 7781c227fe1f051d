"""C5 with its sink: the cleaned table is written in one pass over the input, and the pass itself counts.

Row, missing-value and revenue figures (C3–C5, P6) are metrics observed on the rows on their way into the sink, so no scan
is made for them.  The input may be anything, also what can't be read twice.  Mostly-empty columns are known only when
the pass is over; they stay in the files and are left out on reading, which costs nothing in a columnar format.
Duplicates need rows to meet: they are counted from the written table, when asked for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import nan_to_null, qcol
from ..operators.clean import KEY_COLUMNS, coerce_types
from ..operators.profile import duplicate_rows


def write_observed(df: DataFrame, path: str, metrics: list[Column], mode: str = "overwrite", partition_by: list[str] | None = None) -> dict:
    """Writes ``df`` as Parquet and returns the named aggregates of its rows, taken while they were written.

    The metrics sit right below the sink: only tasks that finished count, whatever was retried.  They are observed in a
    session of their own with the same settings: a session that has observed something can't be serialised any
    more, and the functions of Spark ML models take theirs along to the tasks.
    """
    spark, seen, name = df.sparkSession, Observation(), f"observed_{uuid.uuid4().hex}"
    other = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            other.conf.set(k, v)
    df.createGlobalTempView(name)
    try:
        w = other.table(f"global_temp.{name}").observe(seen, *metrics).write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return dict(seen.get)
    finally:
        spark.catalog.dropGlobalTempView(name)


@dataclass
class StoredCleaning:
    df: DataFrame               # the written table without the mostly-empty columns
    dropped: list[str]
    rows: int
    missing: dict[str, int]     # per column of the input
    amount: dict                # n, total of the amount column; empty if it is missing or dropped
    whole: DataFrame            # the written table with all its columns

    @property
    def stats(self) -> DataFrame:
        """One row: sales_duplicates and missing_<key> per surviving key, as ``run_cleaning`` has it."""
        keys = [c for c in KEY_COLUMNS if c in self.df.columns]
        return duplicate_rows(self.df).select(F.col("duplicates").alias("sales_duplicates"),
                                              *[F.lit(self.missing[c]).cast("long").alias(f"missing_{c}") for c in keys])

    @property
    def overall(self) -> DataFrame:
        """P6 from the observed figures and the duplicates of the written table; raw rows are those that were written."""
        n, has = self.amount.get("n"), bool(self.amount)
        total = (self.amount["total"] or 0.0) if has else None
        return duplicate_rows(self.whole).select(
            F.lit(self.rows).cast("long").alias("rows_raw"), F.lit(self.rows).cast("long").alias("rows_clean"),
            F.col("duplicates").alias("duplicates_raw"), F.lit(self.rows - n if has else 0).cast("long").alias("missing_amount_clean"),
            F.lit(total).cast("double").alias("total_revenue_clean"), F.lit(total / n if has and n else None).cast("double").alias("avg_order_amount_clean"))


def clean_to_parquet(df: DataFrame, path: str, cfg: dict | None = None, amount_col: str = "amount", partition_by: list[str] | None = None) -> StoredCleaning:
    """Coerces types, writes, counts; columns with a missing share above the configured threshold (0.8) don't come back.

    An empty input keeps all its columns.  Partition columns are counted like others but never dropped.
    """
    thr = float((((cfg or {}).get("processing") or {}).get("cleaner") or {}).get("drop_high_missing_columns", {}).get("threshold", 0.8))
    typed = coerce_types(df)
    fields = {f.name: f.dataType for f in typed.schema.fields}
    empty = lambda c: qcol(c).isNull() | F.isnan(qcol(c)) if isinstance(fields[c], (T.FloatType, T.DoubleType)) else qcol(c).isNull()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(empty(c)).alias(f"missing {i}") for i, c in enumerate(typed.columns)]]
    if amount_col in fields:
        a = nan_to_null(qcol(amount_col).cast("double"))
        metrics += [F.count(a).alias("n"), F.sum(a).alias("total")]
    got = write_observed(typed, path, metrics, partition_by=partition_by)
    n, missing = got["rows"], {c: got[f"missing {i}"] for i, c in enumerate(typed.columns)}
    dropped = [c for c in typed.columns if n and missing[c] / n > thr and c not in (partition_by or [])]
    whole = df.sparkSession.read.schema(typed.schema).parquet(path)
    out = whole.select(*[qcol(c) for c in typed.columns if c not in dropped])
    amount = {k: got[k] for k in ("n", "total")} if amount_col in fields and amount_col not in dropped else {}
    return StoredCleaning(out, dropped, n, missing, amount, whole)
