"""Language-model scoring by prediction by partial matching, beside a word unigram base.

Training is one pass: tasks count (order+1)-grams of bytes and words, Spark adds the counts up.  The trie
(``ppm_model.Trie``) is cut by two-byte contexts into parts of at most ``part_grams`` grams; each part is
broadcast on its own and scores, in one pass over the documents, the bytes that follow its contexts.  One
part is the usual case; a larger trie takes more passes, never more memory.  Words: the ``top_words`` most
frequent are broadcast, every other word's count is joined.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import STEP, crc_mod, utf8
from .ppm_model import Trie, U64, count_grams, pieces

#: Counted as the token that ends a text; no word is empty.
STOP = b""


def tokens(text: bytes) -> list[bytes]:
    """Words of a text whose A-Z are lower case, then the end token."""
    return [*text.lower().split(), STOP]


def corpus_counts(train: DataFrame, order: int, words_held: int = 300_000, grams_held: int = 1 << 22) -> DataFrame:
    """(word binary, gram long, n long) over the rows (t binary): a word's row has no gram, a gram's no word.

    Tasks count locally and pass their counts on whenever they hold ``words_held`` words or ``grams_held`` grams.
    """
    arrow = pa.schema([("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])

    def word_rows(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.nulls(len(c), pa.int64()),
                                           pa.array(list(c.values()), pa.int64())], schema=arrow)

    def gram_rows(parts: list) -> pa.RecordBatch:
        code, n = _merged(parts)
        return pa.RecordBatch.from_arrays([pa.nulls(len(code), pa.binary()), pa.array(code.view(np.int64)), pa.array(n)], schema=arrow)

    def run(batches):
        c, parts, held = Counter(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                texts = [t.lower() for t in batch.column(0).slice(at, STEP).to_pylist()]
                for t in texts:
                    c.update(t.split())
                c[STOP] += len(texts)
                for code, _ in pieces(texts, order):
                    parts.append(count_grams(code))
                    held += len(parts[-1][0])
                if held > grams_held:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > grams_held // 2:
                        yield gram_rows(parts)
                        parts, held = [], 0
                if len(c) > words_held:
                    yield word_rows(c)
                    c = Counter()
        if c:
            yield word_rows(c)
        if parts:
            yield gram_rows(parts)

    rows = train.select("t").mapInArrow(run, "word binary, gram long, n long")
    return rows.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    code, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    at = np.argsort(code, kind="stable")
    code, n = code[at], n[at]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first).astype(np.int64) if len(first) else n.astype(np.int64)


def _columns(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    t = df.toArrow()
    return t.column(0).to_numpy().view(U64), t.column(1).to_numpy().astype(np.int64)


def trie_parts(grams: DataFrame, order: int, part_grams: int) -> list[tuple[Trie, np.ndarray | None]]:
    """Generator of (trie, mask of the 65,536 two-byte contexts it serves; None: all of them)."""
    context = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit(0xFFFF)).alias("c2")
    if order < 2:                                       # at most 65,536 grams
        yield Trie(*_columns(grams.select("gram", "n")), order), None
        return
    sizes = grams.groupBy(context).agg(F.count("*").alias("n")).toPandas()      # 65,536 rows at most
    if sizes["n"].sum() <= part_grams:
        yield Trie(*_columns(grams.select("gram", "n")), order), None
        return
    three = F.col("gram").bitwiseAND(F.lit(0xFFFFFF))
    low = _columns(grams.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("g")).agg(F.countDistinct(three)))
    sizes = sizes.sort_values("c2")
    part = np.zeros(65536, np.int32)
    part[sizes["c2"].to_numpy()] = 1 + (np.cumsum(sizes["n"].to_numpy()) - 1) // part_grams
    for p in range(int(part.max()) + 1):                # 0: contexts that training never saw
        mine = np.flatnonzero(part == p)
        if p:
            lo, hi = int(mine.min()), int(mine.max())
            code, n = _columns(grams.where(context.between(lo, hi)).select("gram", "n"))
            keep = part[(code >> U64(8) & U64(0xFFFF)).astype(np.int64)] == p
            code, n = code[keep], n[keep]
        else:
            code, n = np.zeros(0, U64), np.zeros(0, np.int64)
        yield Trie(code, n, order, low), part == p


def _score(df: DataFrame, trie: Trie, mask: np.ndarray | None) -> DataFrame:
    """Adds to ``score`` what this part of the trie knows; other columns pass."""
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((trie, mask))
    fields = df.schema

    def run(batches):
        model, only = shared.value
        for batch in batches:
            names = batch.schema.names
            add = np.zeros(batch.num_rows)
            for at in range(0, batch.num_rows, STEP):
                texts = [t.lower() for t in batch.column(names.index("t")).slice(at, STEP).to_pylist()]
                for code, lens in pieces(texts, model.order):
                    logs = np.zeros(len(code))
                    if only is None:
                        logs = model.logs(code)
                    else:
                        here = only[(code >> U64(8) & U64(0xFFFF)).astype(np.int64)]
                        logs[here] = model.logs(code[here])
                    ends = np.cumsum([n for _, n in lens])
                    sums = np.add.reduceat(logs, np.concatenate([[0], ends[:-1]]))
                    for (i, _), s in zip(lens, sums):
                        add[at + i] += s
            k = names.index("score")
            yield batch.set_column(k, names[k], pa.array(batch.column(k).to_numpy(zero_copy_only=False) + add))

    return df.mapInArrow(run, fields)


def _word_stats(df: DataFrame, frequent: dict[bytes, int]) -> DataFrame:
    """(row, doc_id, held_out, score, n_tokens, n_known, known_logs, rare array<struct<word, n>>) from (row, doc_id, held_out, score, t)."""
    shared = df.sparkSession.sparkContext.broadcast(frequent)
    rare = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
    out = pa.schema([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("known_logs", pa.float64()), ("rare", rare)])

    def run(batches):
        known = {w: math.log10(c + 1) for w, c in shared.value.items()}
        for batch in batches:
            names = batch.schema.names
            stats: list[tuple] = []
            for at in range(0, batch.num_rows, STEP):
                for t in batch.column(names.index("t")).slice(at, STEP).to_pylist():
                    ws = tokens(t)
                    logs = [known.get(w) for w in ws]
                    other = Counter(w for w, g in zip(ws, logs) if g is None)
                    have = [g for g in logs if g is not None]
                    stats.append((len(ws), len(have), math.fsum(have), [{"word": w, "n": n} for w, n in other.items()]))
            cols = list(zip(*stats)) if stats else [()] * 4
            keep = [n for n in names if n != "t"]
            yield pa.RecordBatch.from_arrays([batch.column(names.index(n)) for n in keep] + [pa.array(list(c), f.type) for c, f in zip(cols, out)],
                                             names=keep + out.names)

    return df.mapInArrow(run, "row long, doc_id long, held_out boolean, score double, n_tokens long, n_known long, "
                              "known_logs double, rare array<struct<word: binary, n: long>>")


def ppm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_mod: int = 7, held_rem: int = 2,
               order: int = 5, top_words: int = 200_000, part_grams: int = 2_500_000) -> DataFrame:
    """Scores of every row of ``docs`` under models of the rows whose crc32(id) mod ``held_mod`` is not ``held_rem``.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one word unigram) and score
    (log10 probability of the text, A-Z in lower case, by the PPM model).  Null texts are empty: one end token.
    Rows with a null id are scored, not learned from, and not held out.  Repeated rows count, and are scored,
    each for itself.  An empty table gives no rows.  Other columns are ignored, whatever their names.
    """
    rem = crc_mod(id_col, held_mod)
    src = docs.select(qcol(id_col).cast("long").alias("doc_id"), F.coalesce(rem == held_rem, F.lit(False)).alias("held_out"),
                      (rem != held_rem).alias("learn"), utf8(text_col).alias("t"))
    counts = cut_lineage(corpus_counts(src.where("learn"), order))
    words = counts.where("gram is null").select("word", "n")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_train, n_kinds = int(total[0]), int(total[1])
    top = words.orderBy(F.desc("n"), "word").limit(top_words).toArrow()
    frequent = dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist()))

    work = src.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", F.lit(0.0).alias("score"), "t")
    for trie, mask in trie_parts(counts.where("word is null").select("gram", "n"), order, part_grams):
        work = _score(work, trie, mask)
    scored = cut_lineage(_word_stats(work, frequent))

    found = (scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("k"))
             .join(words, "word").groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("logs")))
    scale = math.log10(n_train + n_kinds + 1)
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("known_logs") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score")
