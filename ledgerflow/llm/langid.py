"""Language identification with error-correcting output codes.

Every language gets a codeword of bits.  One binary classifier per bit tells the languages whose bit is 1
from the others by the byte n-grams of a text: log-odds of hashed n-grams, from counts over all labelled
training texts (each language weighs the same).  A text's n log-odds add up to a margin, scaled by 1/sqrt(n),
so that short texts are less certain.  Decoding sums the logistic loss of the margins against each codeword;
the nearest codeword wins, and a text is flagged where the runner-up is almost as near.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol
from .common import STEP, crc_mod, fresh, utf8

BITS = 14                                   # hashed n-gram classes: 2**BITS
LETTER = re.compile(r"[^\W\d_]")
#: ASCII characters that aren't letters become spaces.
PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
UND = "und"


def prepared(data: bytes) -> bytes | None:
    """The text in lower case with ASCII non-letters as spaces; None if it has no letter."""
    text = data.decode("utf-8", "replace")
    if not LETTER.search(text):
        return None
    return b" " + b" ".join(text.lower().encode().translate(PLAIN).split()) + b" "


def hashed(data: bytes) -> np.ndarray:
    """Counts of the byte bigrams and trigrams by hash class, in bounded pieces of the text."""
    out = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(data), 1 << 20):
        b = np.frombuffer(data[at:at + (1 << 20) + 2], np.uint8).astype(np.uint32)
        two = b[:-1] | b[1:] << np.uint32(8)
        codes = [two | np.uint32(1 << 31)]
        if len(b) > 2:
            codes.append(two[:-1] | b[2:] << np.uint32(16))
        for c in codes:
            out += np.bincount((c * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    return out


def codewords(k: int) -> np.ndarray:
    """k codewords of 0/1: all splits of the languages in two up to 6 languages, else the best of random dense codes."""
    if k <= 6:
        cols = [[int(i in on) for i in range(k)] for r in range(1, k) for on in combinations(range(k), r) if 0 in on]
        return np.array(cols, np.int8).reshape(len(cols), k).T
    rng, best, far = np.random.default_rng(0), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (k, int(np.ceil(10 * np.log2(k)))), dtype=np.int8)
        code = code[:, (code.min(axis=0) == 0) & (code.max(axis=0) == 1)]
        d = (code[:, None] != code[None]).sum(axis=2) + 10**6 * np.eye(k, dtype=int)
        if d.min() > far:
            best, far = code, d.min()
    return best


def ngram_counts(train: DataFrame, max_held: int = 64) -> DataFrame:
    """(lang, cell, n) over the rows (lang, t binary) of all training texts."""
    arrow = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def rows(held: dict[str, np.ndarray]):
        for lang, n in held.items():
            cell = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell.astype(np.int32)), pa.array(n[cell])], schema=arrow)

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = prepared(t)
                    if text is None:
                        continue
                    if lang not in held:
                        if len(held) >= max_held:
                            yield from rows(held)
                            held = {}
                        held[lang] = np.zeros(1 << BITS, np.int64)
                    held[lang] += hashed(text)
        yield from rows(held)

    return train.select("lang", "t").mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray                        # languages x bits, 0/1
    weight: np.ndarray                      # cells x bits, log-odds of bit 1


def fit(train: DataFrame) -> Model:
    """Model of all rows (lang, t); the driver receives 2**BITS counts per language."""
    t = ngram_counts(train).toArrow()
    langs = sorted(set(t.column("lang").to_pylist()))
    at = {x: i for i, x in enumerate(langs)}
    n = np.zeros((len(langs), 1 << BITS))
    np.add.at(n, ([at[x] for x in t.column("lang").to_pylist()], t.column("cell").to_numpy()), t.column("n").to_numpy())
    p = (n + 0.5) / (n + 0.5).sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    weight = np.zeros((1 << BITS, code.shape[1] if len(langs) else 0), np.float32)
    for j in range(weight.shape[1]):
        on = code[:, j] == 1
        weight[:, j] = np.log(p[on].mean(axis=0)) - np.log(p[~on].mean(axis=0))
    return Model(langs, code, weight)


def decode(margin: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Loss of every codeword under the bit margins: mean over bits of log(1 + exp(-margin of the codeword's bit))."""
    return np.logaddexp(0, -(2.0 * code - 1) * margin).mean(axis=1)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_mod: int = 3, held_rem: int = 1, ambiguous_gap: float = 0.02) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous per row of ``docs``.

    Learns from all rows with a non-null ``lang_col`` whose crc32(id) mod ``held_mod`` is not ``held_rem``;
    predictions see the text only.  A text that is null or has no letter, or any text where nothing could
    be learned, is ``und`` with score 0.  Rows with a null id are predicted, not learned from, and not held
    out.  ``score`` is the winner's share of exp(-bits * loss); ``ambiguous``: the two nearest codewords'
    losses differ by less than ``ambiguous_gap`` of the greater.  Ties go to the first language by name.
    """
    kept = docs.select(qcol(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t"))
    model = _fit_on(docs, id_col, text_col, lang_col, held_mod, held_rem)
    out = _predicted(kept, model, ["doc_id"], "t", ["lang_pred", "score", "ambiguous"], ambiguous_gap)
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", held_mod) == held_rem, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def _fit_on(docs, id_col, text_col, lang_col, held_mod, held_rem) -> Model:
    return fit(docs.where(crc_mod(id_col, held_mod) != held_rem).where(qcol(lang_col).isNotNull())
               .select(qcol(lang_col).cast("string").alias("lang"), utf8(text_col).alias("t")))


def _predicted(df: DataFrame, model: Model, keep: list[str], data: str, made: list[str], gap: float) -> DataFrame:
    """Columns ``keep`` of ``df`` and, from the text in ``data``, language, score and ambiguity under the names ``made``."""
    shared = df.sparkSession.sparkContext.broadcast((model.langs, model.code, model.weight))
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(n, t) for n, t in zip(made, (T.StringType(), T.DoubleType(), T.BooleanType()))])

    def run(batches):
        langs, code, weight = shared.value

        def one(t: bytes) -> tuple:
            text = prepared(t) if langs else None
            if text is None:
                return UND, 0.0, False
            n = hashed(text)
            loss = decode((n @ weight) / np.sqrt(n.sum()), code) if code.shape[1] else np.zeros(1)
            best = int(loss.argmin())
            share = np.exp(-code.shape[1] * (loss - loss[best]))
            second = np.partition(loss, 1)[1] if len(loss) > 1 else np.inf
            return langs[best], float(1 / share.sum()), bool(second - loss[best] < gap * second) if len(loss) > 1 else False

        for batch in batches:
            names = batch.schema.names
            got = [one(t) for at in range(0, batch.num_rows, STEP)
                   for t in batch.column(names.index(data)).slice(at, STEP).to_pylist()]
            cols = list(zip(*got)) if got else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index(c)) for c in keep]
                + [pa.array(list(cols[0]), pa.string()), pa.array(list(cols[1]), pa.float64()), pa.array(list(cols[2]), pa.bool_())],
                names=[*keep, *made])

    return df.select(*[qcol(c) for c in keep], qcol(data)).mapInArrow(run, schema)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    **settings) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose language is predicted without ambiguity; ``und`` goes."""
    gap = settings.pop("ambiguous_gap", 0.02)
    model = _fit_on(docs, id_col, text_col, lang_col, settings.get("held_mod", 3), settings.get("held_rem", 1))
    data, *made = fresh(docs, "_bytes", "_lang", "_score", "_ambiguous")
    out = _predicted(docs.withColumn(data, utf8(text_col)), model, docs.columns, data, made, gap)
    return out.where((F.col(made[0]) != UND) & ~F.col(made[2])).drop(*made)
