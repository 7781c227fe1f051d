"""Inferred JSON columns against pandas' flattening of the same documents."""

import json
import math
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from ledgerflow.sources import json_infer as J


def rows_of(spark, docs, **kw):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id long, doc string")
    return J.infer_rows(df, "doc", keep=["id"], **kw)


def test_types_are_merged_over_all_documents(spark):
    docs = ['{"r": [{"a": 1, "n": {"x": 1, "y": {"z": "t"}}, "l": [1, 2]}, {"a": 2.5, "big": 12345678901234567890}]}',
            '{"r": [{"n": {"x": null, "w": true}, "l": [], "e": 1e3, "never": null, "o": {}}]}', '{"r": []}', "broken", None, '{"r": null}']
    got = rows_of(spark, docs, root="r")
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert types == {"id": "bigint", "pos": "int", "a": "double", "big": "decimal(38,0)", "e": "bigint", "l": "array<bigint>", "n.w": "boolean",
                     "n.x": "bigint", "n.y.z": "string", "never": "string"}
    r = sorted(got.collect(), key=lambda x: (x.id, x.pos))
    assert [(x["id"], x["pos"], x["a"], x["n.x"], x["n.y.z"], x["l"]) for x in r] == [
        (0, 0, 1.0, 1, "t", [1, 2]), (0, 1, 2.5, None, None, None), (1, 0, None, None, None, [])]
    assert int(r[1]["big"]) == 12345678901234567890 and r[2]["n.w"] is True and r[2]["e"] == 1000


def test_mixed_kinds_lose_no_value(spark):
    docs = ['[{"a": 1}, {"a": "t"}, {"a": {"b": 2}}, {"a": {"b": {"c": [1, "x"]}}}, {"a": [3, {"d": 4}]}, {"a": null}, {"a": true}]']
    r = rows_of(spark, docs).orderBy("pos").collect()
    assert [x["a"] for x in r] == ["1", "t", None, None, '[3,{"d":4}]', None, "true"]
    assert [x["a.b"] for x in r] == [None, None, 2, None, None, None, None]
    assert [x["a.b.c"] for x in r] == [None] * 3 + [["1", "x"]] + [None] * 3
    r = rows_of(spark, ['[1, {"a": 2}, "t", [5]]', "[null]"]).orderBy("id", "pos").collect()
    assert [(x["value"], x["a"]) for x in r] == [("1", None), (None, 2), ("t", None), ("[5]", None), (None, None)]


def test_lists_of_objects_and_odd_names(spark):
    docs = ['[{"a.b": 1, "a": {"b": 2}, "A": 3, "pos": 4, "it\'s \\"q\\"": {"x": 5}, "OBJECT<": 6, "l": [{"k": 1}, {"m": 1.5}], "`t`": 7, "b\\\\s": 8}]']
    got = rows_of(spark, docs)
    x = got.first()
    assert sorted(x[c] for c in ("a.b", "a.b_2")) == [1, 2] and x["pos"] == 0 and x["pos_2"] == 4 and x["A"] == 3
    assert x["it's \"q\".x"] == 5 and x["OBJECT<"] == 6 and x["`t`"] == 7 and x["b\\s"] == 8
    assert [(e["k"], e["m"]) for e in x["l"]] == [(1, None), (None, 1.5)]


def test_roots_follow_the_declared_reader(spark):
    docs = ['{"meta": 1, "data": [{"k": 1}], "more": [{"k": 9}]}', '{"k": 2}', '{"d": {"data": [{"k": 3}]}}', '{"empty": [], "k": 4}']
    assert sorted((x["id"], x["k"]) for x in rows_of(spark, docs).collect() if x["k"]) == [(0, 1), (1, 2), (3, 4)]
    assert [x["k"] for x in rows_of(spark, docs[2:3], root="d.data").collect()] == [3]


def test_kept_leaves_and_empty_tables(spark):
    df = spark.createDataFrame([(1, '[{"a": 1, "b": "x"}]'), (2, '[{"a": "no", "c": 3}]')], "id long, doc string")
    leaves = J.infer_leaves(J.item_variants(df.where("id = 1"), "doc"))
    got = J.infer_rows(df, "doc", keep=["id"], leaves=leaves).orderBy("id").collect()
    assert [(x["id"], x["a"], x["b"]) for x in got] == [(1, 1, "x"), (2, None, None)]
    none = J.infer_rows(df.limit(0), "doc", keep=["id"])
    assert none.columns == ["id", "pos"] and none.count() == 0
    with pytest.raises(ValueError):
        J.infer_rows(df, "doc", max_columns=1)


def test_random_documents_equal_pandas(spark):
    rng = random.Random(7)

    def value(depth):
        kind = rng.randint(0, 7 if depth < 3 else 4)
        if kind > 4:
            return {rng.choice("abc"): value(depth + 1) for _ in range(rng.randint(1, 3))}
        return [rng.randint(-9, 9), rng.choice(["t", "é\n"]), None, rng.random() < .5, round(rng.uniform(-5, 5), 3)][kind]

    for _ in range(4):
        items = [{rng.choice("abcd"): value(0) for _ in range(rng.randint(0, 4))} for _ in range(60)]
        got = rows_of(spark, [json.dumps(items[k:k + 7]) for k in range(0, 60, 7)])
        want = pd.json_normalize(items)
        cols = [c for c in got.columns if c not in ("id", "pos")]
        full = [c for c in want.columns if want[c].notna().any()]
        assert set(full) <= set(cols)
        types = {f.name: f.dataType for f in got.schema.fields}
        for n, r in enumerate(sorted(got.collect(), key=lambda r: (r.id, r.pos))):
            for c in cols:
                w = want[c].iloc[n] if c in want.columns else None
                if w is None or isinstance(w, float) and math.isnan(w):
                    assert r[c] is None, (c, items[n])
                elif isinstance(types[c], T.StringType):
                    assert r[c] == (w if isinstance(w, str) else json.dumps(w.item() if hasattr(w, "item") else w)) or float(r[c]) == float(w)
                else:
                    assert r[c] == w
