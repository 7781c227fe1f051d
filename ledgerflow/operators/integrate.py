"""Integration (I1–I9): tag, route, union, project, side-by-side concat.

Routing decides from names and column sets only (driver-side, no job).  The
union is ``unionByName(allowMissingColumns=True)``: missing columns become NULL,
column order is first-seen, numeric types widen as in SQL UNION ALL.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import is_numeric, qcol
from ..functions.rows import with_row_index

log = logging.getLogger(__name__)

# Name synonyms and required column sets used to route a part.
NAME_TARGETS = {
    "sales": "sales", "orders": "sales",
    "users": "users", "user": "users",
    "products": "products", "product": "products",
    "customers": "customers", "clients": "customers", "customer": "customers",
}
COLUMN_TARGETS = (
    ({"order_id", "amount"}, "sales"),
    ({"customer_id", "country"}, "customers"),
    ({"id", "firstname", "email"}, "users"),
    ({"id", "title", "price"}, "products"),
)


def add_source(df: DataFrame, source: str, column: str = "source") -> DataFrame:
    """Tag every row with its source kind; an existing column only has its
    NULLs filled; a frame without columns is returned untouched."""
    if not df.columns:
        return df
    if column in df.columns:
        return df.withColumn(column, F.coalesce(qcol(column), F.lit(source)))
    return df.withColumn(column, F.lit(source))


def classify_target(name: str, columns: list[str], explicit: str | None = None) -> str | None:
    """Routing: explicit target, else the name synonym, else the column set."""
    if explicit:
        return explicit.lower()
    low = (name or "").lower()
    if low in NAME_TARGETS:
        return NAME_TARGETS[low]
    cols = {c.lower() for c in columns}
    for need, target in COLUMN_TARGETS:
        if need <= cols:
            return target
    return None


def union_sources(parts: list[DataFrame]) -> DataFrame | None:
    """I4 core: stack parts by column name, NULL for missing columns."""
    parts = [p for p in parts if p is not None and p.columns]
    if not parts:
        return None
    # a column that is text here and a date or number there is stacked as text; cleaning coerces it
    types: dict[str, list] = {}
    for p in parts:
        for f in p.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    mixed = {c for c, ts in types.items()
             if len({t.simpleString() for t in ts}) > 1 and not all(is_numeric(t) for t in ts)
             and any(isinstance(t, T.StringType) or is_numeric(t) for t in ts)}
    parts = [p.withColumns({c: qcol(c).cast("string") for c in p.columns if c in mixed}) if mixed else p for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _is_empty(df: DataFrame) -> bool:
    return df is None or not df.columns


def load_sources(spark: SparkSession, cfg: dict) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """I4: load every configured source, tag it, route it and union the sales parts.

    ``cfg["sources"]`` has lists ``sql`` (query / jdbc), ``csv`` (path, schema),
    ``json`` (path or a DataFrame of landed documents, json_root, item_schema,
    optional paginate dict).  A source that fails to load or has no columns is
    logged and skipped.  Sales *and* customers parts go to the sales union;
    unrouted SQL goes to sales, unrouted CSV is dropped, JSON also routes by name
    substring; users / products keep the last part seen.  With no sales part at
    all, ``cfg["default_paths"]`` (CSV files) are tried.
    """
    from ..sources.files import read_csv
    from ..sources.json_docs import assemble_pages, extract_root_rows, flatten, read_documents
    from ..sources.sql import read_sql_source

    sources = cfg.get("sources") or {}
    sales_parts: list[DataFrame] = []
    users = products = None

    def route(kind: str, name: str, df: DataFrame, explicit: str | None, tag: str):
        nonlocal users, products
        dst = classify_target(name, df.columns, explicit)
        if kind == "json":
            if dst in ("sales", "customers") or "sale" in name or "order" in name:
                dst = "sales"
            elif dst == "users" or "user" in name:
                dst = "users"
            elif dst == "products" or "product" in name:
                dst = "products"
        tagged = add_source(df, tag)
        if dst in ("sales", "customers"):
            sales_parts.append(tagged)
        elif dst == "users":
            users = tagged
        elif dst == "products":
            products = tagged
        elif kind == "sql":
            log.info("SQL part %r has no target; stacked into sales", name)
            sales_parts.append(tagged)

    for item in sources.get("sql") or []:
        df, _ = read_sql_source(spark, item)
        if not _is_empty(df):
            route("sql", str(item.get("name", "")).lower(), df, item.get("target"), "db")
    for item in sources.get("csv") or []:
        path = item.get("path")
        if not path:
            continue
        try:
            df = read_csv(spark, path, item.get("schema"), **(item.get("options") or {}))
        except Exception as e:  # noqa: BLE001 — a bad source is skipped, as in the reference
            log.warning("CSV skipped (%s): %s", path, e)
            continue
        if not _is_empty(df):
            route("csv", str(item.get("name", "")).lower(), df, item.get("target"), "file")
    for item in sources.get("json") or []:
        try:
            docs = item.get("docs")
            if docs is None:
                docs = read_documents(spark, item["path"])
            doc_col = item.get("doc_col", "doc")
            pg = item.get("paginate")
            if isinstance(pg, dict) and pg.get("enabled"):
                df = assemble_pages(docs, doc_col, pg.get("page_col", "page_no"), item["item_schema"],
                                    item.get("json_root"), pg.get("key_cols"), int(pg.get("page_limit", 100)),
                                    int(pg.get("max_pages", 100)), pg.get("response_total_key"))
                df = df.drop(pg.get("page_col", "page_no"), "pos", *(pg.get("key_cols") or []))
            else:
                df = extract_root_rows(docs, doc_col, item.get("json_root"), item["item_schema"]).drop("pos")
            df = flatten(df)
        except Exception as e:  # noqa: BLE001
            log.error("JSON source failed (%s): %s", item.get("name"), e)
            continue
        route("json", str(item.get("name", "")).lower(), df, item.get("target"), "api")

    for item in sources.get("excel") or []:
        log.warning("Excel source %r skipped: Excel is not read (export it to CSV or Parquet)",
                    item.get("name") or item.get("path"))

    if not sales_parts:
        for pth in cfg.get("default_paths") or []:
            try:
                sales_parts.append(add_source(read_csv(spark, pth), "file"))
            except Exception as e:  # noqa: BLE001
                log.warning("default CSV skipped (%s): %s", pth, e)
    return union_sources(sales_parts), users, products


def project_keep(df: DataFrame, keep: list[str] | None) -> DataFrame:
    """Keep the listed columns that exist; none listed or none existing -> all."""
    if not keep:
        return df
    cols = [c for c in keep if c in df.columns]
    return df.select(*[qcol(c) for c in cols]) if cols else df


def concat_columns(frames: dict[str, DataFrame], order_by: dict[str, list[str]],
                   keep: dict[str, list[str]] | None = None) -> DataFrame:
    """Side-by-side concat — row i of every frame on one row, the shorter
    frames padded with NULLs.  Each frame is numbered in its ``order_by`` order
    (distributed row index), then the frames are full-outer-joined on the number.
    A column name already used by an earlier frame is prefixed ``<frame>.``.
    Output keeps the position as ``row_idx``."""
    keep = keep or {}
    seen: set[str] = set()
    out = None
    for name, df in frames.items():
        if _is_empty(df):
            continue
        df = project_keep(df, keep.get(name))
        ren = []
        for c in df.columns:
            new = f"{name}.{c}" if c in seen or c == "row_idx" else c
            seen.add(new)
            ren.append(qcol(c).alias(new))
        df = df.select(*ren)
        indexed = with_row_index(df, [qcol(f"{name}.{c}") if f"{name}.{c}" in df.columns else qcol(c)
                                      for c in order_by.get(name, [])])
        out = indexed if out is None else out.join(indexed, "row_idx", "full_outer")
    return out
