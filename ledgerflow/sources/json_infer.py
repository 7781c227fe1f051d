"""JSON rows without a declared schema (S3 + S4): columns are inferred from all documents.

The items at the root become VARIANT values.  One aggregation merges the shapes of all of them
(``schema_of_variant_agg``, combined map-side); only the merged shape reaches the driver.  Where a field holds objects
in some rows and other values in others, a further aggregation looks at the two apart, one per nesting level with
such fields.  With the shape known, every leaf is taken out by its path and type in one projection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol
from .json_docs import items_of, root_value


@dataclass(frozen=True)
class Leaf:
    """A column of the result: its path in the item, its Spark type, and whether objects at the path are passed over."""

    path: tuple[str, ...]
    type: str
    beside_objects: bool = False


def item_variants(docs: DataFrame, doc_col: str, root: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """(keep..., pos, item variant): the items at ``root`` of every document, by the rules of ``extract_root_rows``."""
    raw = root_value(qcol(doc_col), root)
    return docs.select(*[qcol(c) for c in keep or []], F.posexplode(items_of(raw, T.VariantType())).alias("pos", "item"))


def _shape(text: str | None) -> T.DataType:
    """The type that a merged shape such as ``OBJECT<a: BIGINT>`` names; quoted names stay as they are."""
    if text is None:
        return T.NullType()
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    return T._parse_datatype_string("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts))


def _stored(t: T.DataType) -> str:
    """The Spark type of a leaf: fractions are doubles, mixed values text, in lists and their objects too."""
    if isinstance(t, T.DecimalType):
        return "double" if t.scale else "bigint" if t.precision <= 18 else "decimal(38,0)"
    if isinstance(t, T.ArrayType):
        return f"array<{_stored(t.elementType)}>"
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_stored(f.dataType)}" for f in t.fields) + ">" if t.fields else "string"
    return "string" if isinstance(t, (T.VariantType, T.NullType)) else t.simpleString()


def _member(v: Column, name: str) -> Column:
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(v, f"$['{name}']", "variant")
    if '"' not in name and "\\" not in name:
        return F.try_variant_get(v, f'$["{name}"]', "variant")
    return F.element_at(F.when(_is_object(v), v).cast("map<string,variant>"), F.lit(name))


def _at(path: tuple[str, ...], v: Column) -> Column:
    for name in path:
        v = _member(v, name)
    return v


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))


def infer_leaves(items: DataFrame, item_col: str = "item", max_columns: int = 10_000) -> list[Leaf]:
    """The leaves of all items' merged shape, in the order of their paths; more than ``max_columns`` raise an error."""
    leaves: list[Leaf] = []
    todo: list[tuple[str, ...]] = [()]
    while todo:
        cells = []
        for k, path in enumerate(todo):
            v = _at(path, qcol(item_col))
            cells += [F.schema_of_variant_agg(F.when(_is_object(v), v)).alias(f"o{k}"),
                      F.schema_of_variant_agg(F.when(~_is_object(v), v)).alias(f"x{k}")]
        row, mixed = items.agg(*cells).first(), []

        def walk(path: tuple[str, ...], t: T.DataType) -> None:
            if isinstance(t, T.StructType):
                for f in t.fields:
                    walk((*path, f.name), f.dataType)
            elif isinstance(t, T.VariantType):
                mixed.append(path)
            else:
                leaves.append(Leaf(path, _stored(t)))

        for k, path in enumerate(todo):
            objects, others = _shape(row[f"o{k}"]), _shape(row[f"x{k}"])
            if not isinstance(others, T.NullType):
                leaves.append(Leaf(path, _stored(others), True))
            if isinstance(objects, T.StructType):
                walk(path, objects)
        if len(leaves) + len(mixed) > max_columns:
            raise ValueError(f"more than {max_columns} columns: keys that are data belong in a map, not in columns")
        todo = mixed
    return sorted(leaves, key=lambda x: x.path)


def leaf_columns(item: Column, leaves: list[Leaf], taken: list[str], sep: str = ".") -> list[Column]:
    """A column per leaf, named by its joined path; names that are ``taken`` (in any case) get a number."""
    used, out = {n.lower() for n in taken}, []
    for leaf in leaves:
        v = _at(leaf.path, item)
        got = F.try_variant_get(F.when(~_is_object(v), v) if leaf.beside_objects else v, "$", leaf.type)
        name = base = sep.join(leaf.path) if leaf.path else "value"
        n = 1
        while name.lower() in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name.lower())
        out.append(got.alias(name))
    return out


def infer_rows(docs: DataFrame, doc_col: str, root: str | None = None, keep: list[str] | None = None,
               leaves: list[Leaf] | None = None, max_columns: int = 10_000) -> DataFrame:
    """One row per item at ``root`` of each JSON document: ``keep``, ``pos``, and a column per leaf of the items.

    Nested objects become dotted columns, lists stay lists.  A field that is missing or null in an item is null.
    Whole numbers are BIGINT (DECIMAL(38,0) beyond it), numbers with fractions DOUBLE; a field of mixed kinds is text,
    beside the columns of the objects it holds in other rows.  Items that are no objects go to a column ``value``.
    Malformed documents give no rows.  Columns come in the order of their paths.  ``leaves`` from an earlier
    ``infer_leaves`` spares the scan that finds them; values of another type are then null.
    """
    items = item_variants(docs, doc_col, root, keep)
    if leaves is None:
        leaves = infer_leaves(items, "item", max_columns)
    kept = [c for c in items.columns if c != "item"]
    return items.select(*[qcol(c) for c in kept], *leaf_columns(qcol("item"), leaves, kept))
