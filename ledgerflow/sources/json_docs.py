"""JSON documents at rest (S3–S5): root extraction, flattening, page assembly.

The reference pulls JSON from an HTTP API; here the responses are already landed
(one document per row, e.g. ``spark.read.text(path, wholetext=True)`` or a string
column) and everything runs as column expressions: ``get_json_object`` for the
root path, ``from_json`` with the caller's item schema, ``posexplode`` for rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, doc)."""
    return (spark.read.text(path, wholetext=True)
                 .select(F.input_file_name().alias("path"), F.col("value").alias("doc")))


def _json_path(root: str) -> str:
    return "$" + "".join(f"['{p}']" for p in root.split("."))


def root_value(doc: Column, root: str | None) -> Column:
    """The JSON text at the dotted ``root`` path; the whole document when the path
    is missing (or not given); NULL when the path is there and holds a JSON null."""
    if not root:
        return doc
    *above, last = root.split(".")
    parent = F.get_json_object(doc, _json_path(".".join(above))) if above else doc
    there = F.array_contains(F.json_object_keys(parent), F.lit(last))
    return F.coalesce(F.get_json_object(doc, _json_path(root)), F.when(~F.coalesce(there, F.lit(False)), doc))


def _member(raw: Column, key: Column) -> Column:
    """JSON text of the member named by a per-row key (path built per row)."""
    return F.call_function("get_json_object", raw, F.concat(F.lit("$['"), key, F.lit("']")))


def _first_char(c: Column) -> Column:
    return F.substring(F.ltrim(c), 1, 1)


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def items_of(raw: Column, item_schema: T.StructType | T.VariantType | str, wrap_object: bool = True) -> Column:
    """Array of items from a JSON value: a list is the rows; an object yields its
    first list-valued member; an object without one, or with an empty one, is a single row when
    ``wrap_object`` (the paged reader appends nothing for it).  Malformed text
    yields no rows.  Every text is taken from its document and parsed once."""
    one = _schema(item_schema)
    arr_type = T.ArrayType(one)

    def of(raw: Column) -> Column:
        single = F.array(F.from_json(raw, "variant" if isinstance(one, T.VariantType) else one)) if wrap_object else F.array().cast(arr_type)
        first_list = lambda keys: F.get(F.filter(F.transform(keys, lambda k: _member(raw, k)), lambda m: _first_char(m) == "["), 0)
        of_list = lambda items: F.when(F.size(items) > 0, items).otherwise(single)
        # json_object_keys is NULL for text that is not a valid object: no rows from it
        from_obj = _let(F.json_object_keys(raw), lambda keys: F.when(keys.isNull(), F.lit(None).cast(arr_type))
                        .otherwise(_let(F.from_json(first_list(keys), arr_type), of_list)))
        return F.when(_first_char(raw) == "[", F.from_json(raw, arr_type)).when(_first_char(raw) == "{", from_obj)

    return _let(raw, of)


def _schema(s: T.DataType | str) -> T.DataType:
    return s if isinstance(s, T.DataType) else T._parse_datatype_string(s)


def extract_root_rows(docs: DataFrame, doc_col: str, root: str | None, item_schema: T.StructType | str,
                      keep: list[str] | None = None) -> DataFrame:
    """S3: one output row per item found at ``root`` in each document, with its
    0-based position ``pos`` and the item's fields as columns."""
    raw = root_value(qcol(doc_col), root)
    keep_cols = [qcol(c) for c in (keep or [])]
    x = docs.select(*keep_cols, F.posexplode(items_of(raw, item_schema)).alias("pos", "item"))
    return x.select(*[qcol(c) for c in (keep or [])], "pos", "item.*")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become top-level columns named ``a.b.c``; arrays
    and maps are kept as values."""
    out: list[Column] = []

    def walk(prefix: list[str], dt: T.DataType):
        if isinstance(dt, T.StructType) and prefix:
            for f in dt.fields:
                walk(prefix + [f.name], f.dataType)
            return
        ref = qcol(prefix[0])
        for p in prefix[1:]:
            ref = ref.getField(p)
        out.append(ref.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*out)


def assemble_pages(pages: DataFrame, doc_col: str, page_col: str, item_schema: T.StructType | str,
                   root: str | None = None, key_cols: list[str] | None = None, limit: int = 100,
                   max_pages: int | None = 100, total_path: str | None = None) -> DataFrame:
    """Assemble paged responses that were landed one page per row.

    Per stream (``key_cols``), pages are taken in page order and kept up to and
    including the first page that stops the reader: a page with fewer than
    ``limit`` items, or the running item count reaching the response's total
    (``total_path``), and never more than ``max_pages`` pages (None: no bound).  The running count is a
    window over page-level rows; the stop page
    is an aggregate; the items are exploded only for the pages kept.
    """
    keys = [qcol(c) for c in (key_cols or [])]
    doc = qcol(doc_col)
    raw = root_value(doc, root)
    page = pages.select(*keys, qcol(page_col).alias("_page"), doc.alias("_doc"),
                        items_of(raw, item_schema, wrap_object=False).alias("_items"),
                        (F.get_json_object(doc, _json_path(total_path)).try_cast("long")
                         if total_path else F.lit(None).cast("long")).alias("_total"))
    info = page.select(*[F.col(c) for c in (key_cols or [])], "_page", "_total",
                       F.coalesce(F.size("_items"), F.lit(0)).alias("_n"))
    w = Window.partitionBy(*[F.col(c) for c in (key_cols or [])]).orderBy("_page") \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    info = info.withColumn("_cum", F.sum("_n").over(w))
    # a page stops the reader by its extracted row count, whatever the root's shape
    stop = (F.col("_n") < limit) | \
           (F.col("_total").isNotNull() & (F.col("_total") > 0) & (F.col("_cum") >= F.col("_total")))
    if max_pages is not None:                           # by rank: streams may be numbered from any page
        stop = stop | (F.row_number().over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) >= max_pages)
    info = info.withColumn("_stops", stop)
    first_stop = info.groupBy(*(key_cols or [])).agg(F.min(F.when(F.col("_stops"), F.col("_page"))).alias("_stop"))
    if key_cols:
        kept = page.join(first_stop, key_cols, "inner")
    else:  # a single stream: the stop page is one value
        kept = page.withColumn("_stop", first_stop.select("_stop").scalar())
    kept = kept.where(F.col("_stop").isNull() | (F.col("_page") <= F.col("_stop")))
    rows = kept.select(*[F.col(c) for c in (key_cols or [])], F.col("_page").alias(page_col),
                       F.posexplode("_items").alias("pos", "item"))
    return rows.select(*(key_cols or []), page_col, "pos", "item.*")
