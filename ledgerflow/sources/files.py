"""File sources and sinks.

CSV is read with an explicit schema when one is known (inference costs a full
extra pass over the data), in PERMISSIVE mode so a malformed row becomes NULLs
instead of failing the whole job.  Parquet is the interchange format for the
``raw`` / ``cleaned`` artifacts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import path_exists

# Per-table column types of the typed CSV load.
TYPED_TABLES = {
    "sales": T.StructType([
        T.StructField("order_id", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]),
    "customers": T.StructType([
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
    ]),
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             corrupt_column: str | None = None, **options) -> DataFrame:
    """Header row, explicit or inferred types, extra reader options passed
    through (``multiLine=True`` for line breaks in quotes: such a file is one task); a quote
    inside quotes is doubled; a missing path raises ``FileNotFoundError`` up front.  Malformed rows
    become NULLs (PERMISSIVE); with an explicit schema and ``corrupt_column`` the
    raw text of such rows is kept in that column instead of failing the job."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"CSV not found: {path}")
    opts = {"header": "true", "mode": "PERMISSIVE", "quote": '"', "escape": '"'}
    opts.update({k: str(v) for k, v in options.items()})
    reader = spark.read.options(**opts)
    if schema is not None:
        if corrupt_column:
            sch = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
            schema = T.StructType([*sch.fields, T.StructField(corrupt_column, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    return path


def save_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Write as Parquet (parents are created by the writer).  At scale pass
    ``partition_by`` (e.g. a month column) so later reads prune partitions."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_typed_csv(spark: SparkSession, path: str, table: str, target: str | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """CSV with the table's explicit column types; with ``target`` it also
    replaces that catalog table (S7 overwrite) and returns the stored table."""
    from .tables import save_table  # local import: tables imports nothing from here

    sch = schema or TYPED_TABLES.get(table)
    df = read_csv(spark, path, sch)
    if target:
        save_table(df, target, if_exists="replace")
        return spark.table(target)
    return df
