"""Toxic passages by maximum-scoring segment search.

Weights are log-odds of toxic against clean labelled texts under a symmetric Dirichlet prior.  Features are
words and, for inflected forms, their first 4 to 8 bytes; each counts once per text, so that repeated lines
weigh no more than others.  Only features whose log-odds are significantly positive keep a weight, and a word
weighs as much as its best feature.  A text's
score sequence is weight - drift per word.  All maximal scoring segments come from one linear scan.  Under
the clean word distribution segment scores follow an extreme-value law with rate ``lam`` (the root of
E exp(lam * score) = 1), so a segment of score S in a text of n words has E-value K n exp(-lam S); segments
below ``max_e`` are reported.  K is estimated on all clean training rows.  A text's evidence, lam * (sum of its significant segments) - ln n, is
calibrated to a probability on the labelled training rows.
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
from .common import crc_mod, hash_share, rows_of, table, utf8

#: A-Z in lower case, other ASCII that isn't a letter or digit is a space.
WORDS = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))

PREFIXES = (4, 5, 6, 7, 8)
#: Words whose weight a task remembers at most.
REMEMBERED = 200_000


def words(data: bytes) -> list[bytes]:
    return data.translate(WORDS).split()


def features(word: bytes) -> list[bytes]:
    """The word and its marked prefixes."""
    return [word, *(b"^" + word[:k] for k in PREFIXES if len(word) > k)]


def class_counts(rows: DataFrame, held: int = 300_000) -> DataFrame:
    """(word, toxic, clean): texts of either class with the feature, over the rows (toxic int, t binary)."""
    arrow = pa.schema([("word", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        c = (Counter(), Counter())

        def out():
            return table([(w, c[1][w], c[0][w]) for w in {*c[0], *c[1]}], arrow)

        for batch in batches:
            for y, t in rows_of(batch):
                c[int(y)].update({f for w in set(words(t)) for f in features(w)})
                if len(c[0]) + len(c[1]) > held:
                    yield out()
                    c[0].clear(), c[1].clear()
        yield out()

    got = rows.select("toxic", "t").mapInArrow(run, "word binary, toxic long, clean long")
    return got.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def significant(counts: DataFrame, prior: float = 0.5, min_z: float = 3.0) -> tuple[dict[bytes, tuple[float, float]], float]:
    """{feature: (log-odds, share of the clean counts)} of all features with a z-score of ``min_z`` or more, and the drift.

    ``prior`` is added to every count; z is the log-odds over their standard error.  The rows counted are a bounded
    sample, and a feature needs several toxic ones, which bounds the features.
    """
    n = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0)), F.count("*")).first()
    nt, nc, kinds = float(n[0]), float(n[1]), float(n[2])
    if not nt or not nc:
        return {}, 0.1
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (F.lit(nt + prior * (kinds + 1)) - t)) - F.log(c / (F.lit(nc + prior * (kinds + 1)) - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    got = (counts.select("word", odds.alias("odds"), z.alias("z"), (F.col("clean") / F.lit(nc)).alias("share"))
           .where(F.col("z") >= min_z).orderBy("word").toArrow())
    lex = dict(zip(got.column("word").to_pylist(), zip(got.column("odds").to_pylist(), got.column("share").to_pylist())))
    return lex, max(0.1, 2 * sum(o * p for o, p in lex.values()))


def rate(lexicon: dict[bytes, tuple[float, float]], drift: float) -> float:
    """lam > 0 with E exp(lam * score) = 1 over the clean words (a word unseen there counts as a millionth)."""
    o = np.array([x for x, _ in lexicon.values()]) - drift
    p = np.maximum([x for _, x in lexicon.values()], 1e-6) if lexicon else np.zeros(0)
    f = lambda x: math.log(float((p * np.exp(x * o)).sum()) + max(0.0, 1 - float(p.sum())) * math.exp(-x * drift))
    lo, hi = 1e-6, 1e-3
    while f(hi) < 0 and hi < 50:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return (lo + hi) / 2


def segments(at: list[int], gain: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last word, score) of a sequence that gains ``gain`` at positions ``at`` and loses ``drift`` at every word.

    Linear time: each candidate keeps the sums before and after it; a new one joins backwards to the
    nearest candidate that starts lower, as long as that doesn't end higher.
    """
    found: list[list] = []                  # first, last, sum before, sum after, candidate with a lower sum before it
    total, nxt = 0.0, 0
    for i, g in zip(at, gain):
        total -= drift * (i - nxt)
        nxt = i + 1
        s = g - drift
        if s <= 0:
            total += s
            continue
        new = [i, i, total, total + s, -1]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            new[4] = j
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(a, b, r - l) for a, b, l, r, _ in found]


def passages(docs: DataFrame, lexicon: dict[bytes, tuple[float, float]], drift: float, lam: float, log_k: float = 0.0,
             max_e: float = 1.0) -> DataFrame:
    """(doc_id, learn, n_words, evidence, passages array<struct<first, last, score, e_value>>) from (doc_id, learn, t)."""
    shared = docs.sparkSession.sparkContext.broadcast({w: o for w, (o, _) in lexicon.items()})
    seg = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])
    arrow = pa.schema([("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_words", pa.int64()), ("evidence", pa.float64()), ("passages", pa.list_(seg))])

    def run(batches):
        weight, memo = shared.value, {}

        def gain(w: bytes) -> float:
            if w not in memo:
                if len(memo) >= REMEMBERED:
                    memo.clear()
                memo[w] = max((weight.get(f, 0.0) for f in features(w)), default=0.0)
            return memo[w]

        for batch in batches:
            out = []
            for doc, learn, t in rows_of(batch):
                ws = words(t)
                hits = [(i, g) for i, g in enumerate(map(gain, ws)) if g]
                got = []
                for a, b, s in segments([i for i, _ in hits], [g for _, g in hits], drift):
                    e = math.exp(min(700.0, log_k + math.log(len(ws)) - lam * s))
                    if e <= max_e:
                        got.append({"first": a, "last": b, "score": s, "e_value": e})
                evidence = lam * sum(g["score"] for g in got) - math.log(max(1, len(ws)))
                out.append((doc, learn, len(ws), evidence, got))
            yield table(out, arrow)

    return docs.select("doc_id", "learn", "t").mapInArrow(
        run, "doc_id long, learn boolean, n_words long, evidence double, "
             "passages array<struct<first: long, last: long, score: double, e_value: double>>")


def extreme_constant(docs: DataFrame, clean: DataFrame, lexicon: dict[bytes, tuple[float, float]], drift: float, lam: float) -> float:
    """ln K: mean of lam * (best segment) - ln n over the texts of ``docs`` whose doc_id is in ``clean``, less Euler's constant.

    A text without a segment has a best one of 0; texts without words are left out, and without any text K is 1.
    """
    best = F.coalesce(F.array_max(F.transform("passages", lambda p: p["score"])), F.lit(0.0))
    rows = (passages(docs, lexicon, drift, lam, 0.0, math.inf).where("n_words > 0")
            .select("doc_id", (F.lit(lam) * best - F.log("n_words")).alias("x")).join(clean.select("doc_id"), "doc_id"))
    mean = rows.agg(F.avg("x")).first()[0]
    return 0.0 if mean is None else round(mean - float(np.euler_gamma), 9)     # the sum's order doesn't decide on a segment


def logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """(intercept, slope >= 0) of P(toxic | x) from counts by x, with a little ridge; Newton steps."""
    w = np.zeros(2)
    X = np.stack([np.ones_like(x), x], axis=1)
    n = toxic + clean
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        g = X.T @ (toxic - n * p) - 1e-3 * w
        step = np.linalg.solve((X * (n * p * (1 - p))[:, None]).T @ X + 1e-3 * np.eye(2), g)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    if w[1] < 0:
        w = np.array([math.log((toxic.sum() + 1) / (clean.sum() + 1)), 0.0])
    return float(w[0]), float(w[1])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             held_mod: int = 5, held_rem: int = 0, rows_per_class: int = 50_000, max_e: float = 1.0) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words and passages of every row of ``docs``.

    Word weights are learned from labelled rows whose crc32(id) mod ``held_mod`` is not ``held_rem``: all of
    them up to ``rows_per_class`` ids a class, beyond that about so many by hash of the id (a bounded, documented
    sample).  The calibration uses all labelled training rows.  A document with several labels is
    toxic if one says so; null labels are ignored.  Null and empty texts have no passage and get the score of
    no evidence.  Rows with a null id are scored, not learned from, and not held out.  With one class or no
    labels nothing can be learned: the score is the add-one share of toxic labels.
    """
    rem = crc_mod(id_col, held_mod)
    src = docs.select(qcol(id_col).cast("long").alias("doc_id"), F.coalesce(rem != held_rem, F.lit(False)).alias("learn"), utf8(text_col).alias("t"))
    marks = (labels.select(qcol(id_col).cast("long").alias("doc_id"), qcol(label_col).cast("int").alias("toxic"))
             .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.least(F.greatest("toxic", F.lit(0)), F.lit(1))).alias("toxic"))
             .where(crc_mod("doc_id", held_mod) != held_rem))
    marks = cut_lineage(marks)
    n = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}      # two rows
    pick = [marks.where(F.col("toxic") == y).where(hash_share("doc_id", rows_per_class, n.get(y, 0))) for y in (0, 1)]
    lexicon, drift = significant(cut_lineage(class_counts(src.join(F.broadcast(pick[0].union(pick[1])), "doc_id"))))
    lam = rate(lexicon, drift) if lexicon else 1.0

    # the extreme-value constant: mean of lam * S - ln n over clean training texts is ln K plus Euler's constant
    log_k = extreme_constant(src.where("learn"), marks.where("toxic = 0"), lexicon, drift, lam) if lexicon else 0.0
    found = cut_lineage(passages(src, lexicon, drift, lam, log_k, max_e))
    # counts by cells of a quarter, farther out of a fortieth of the logarithm; a cell stands for its mean
    e, far = F.col("evidence"), 100.0
    cell = F.when(F.abs(e) <= far, F.round(e * 4)).otherwise(F.signum(e) * (4 * far + 1 + F.round(F.log(F.abs(e) / far) * 40))).cast("int")
    hist = (found.where("learn").select("doc_id", "evidence", cell.alias("cell")).join(marks, "doc_id").groupBy("cell")
            .agg(F.avg("evidence").alias("x"), F.sum("toxic").alias("y"), F.sum(1 - F.col("toxic")).alias("n")).orderBy("cell").toPandas())
    a, b = logistic(hist["x"].to_numpy(float).round(9), hist["y"].to_numpy(float), hist["n"].to_numpy(float)) if len(hist) else (0.0, 0.0)
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * e)))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", held_mod) == held_rem, F.lit(False)).alias("held_out"),
                        score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "n_words", "passages")
