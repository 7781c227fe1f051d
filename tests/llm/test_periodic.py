import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from ledgerflow.llm import periodic as P
from ledgerflow.llm.recompression import Grammar

from .conftest import ODD


def runs_of(t, least=4, least_words=6):
    """Every maximal stretch of every period, smallest period of each."""
    out = {}
    for q in range(1, len(t) // least + 1):
        i = 0
        while i + q < len(t):
            if t[i] != t[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(t) and t[i] == t[i + q]:
                i += 1
            if i - s + q >= max(least_words, least * q):
                out.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def repetitive(rng, kinds=(1, 2, 5)):
    t = []
    while rng.random() < .85 and len(t) < 200:
        t += [rng.randint(0, rng.choice(kinds)) for _ in range(rng.randint(1, 6))] * rng.randint(1, 9)
    return t


def test_extensions_equal_direct_comparison():
    rng = random.Random(0)
    for _ in range(60):
        body = repetitive(rng)
        t = np.array([98, *body, 99])
        g = Grammar(t)
        pairs = [(i, j) for i in range(1, len(t) - 1) for j in range(i + 1, len(t))]
        rng.shuffle(pairs)
        if not pairs:
            continue
        i, j = np.array(pairs[:400]).T
        right = [next(k for k in range(len(t)) if b + k == len(t) or t[a + k] != t[b + k]) for a, b in zip(i, j)]
        left = [next(k for k in range(len(t)) if a < k or t[a - k] != t[b - k]) for a, b in zip(i, j)]
        assert g.extend(i, j).tolist() == right and g.extend(i, j, -1).tolist() == left


def test_grammar_is_small_for_repetitive_texts():
    t = np.concatenate([[7], np.tile([0, 1, 0, 2, 3], 20_000), [8]])
    g = Grammar(t)
    assert len(g.symbols[-1]) < 20 and len({int(s) for level in g.symbols for s in np.unique(level)}) < 300


def test_runs_equal_brute_force(monkeypatch):
    rng = random.Random(1)
    for k in range(150):
        monkeypatch.setattr(P, "PAIRS", rng.choice([1, 50, 10**6]))
        texts = [repetitive(rng, rng.choice([(1,), (1, 2, 5), (9,)])) for _ in range(rng.randint(0, 6))]
        assert P.find_runs([np.array(t, np.int64) for t in texts]) == [runs_of(t) for t in texts]
    assert P.find_runs([np.array([1, 2, 1, 2, 1, 2, 1], np.int64)], least=2, least_words=4) == [[(0, 7, 2)]]


def expected(doc_id, text, tails):
    w = (text or "").encode().split()
    if tails and doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = runs_of(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_query_rows_equal_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(P, "BATCH_WORDS", 300)
    rng = random.Random(2)
    rows = [r for r in ODD if r[0] != 6] + [(6, "word " * 300, "en", "c"), (8, "tie tie tie tie tie tie x a b a b a b a b a b a b a b a b", "en", "a")]
    for i in range(120):
        rows.append((100 + i, " ".join(f"é{x}" for x in repetitive(rng)) + rng.choice(["", " \x85 \x1c", "\n"]), "en", "a"))
    for tails in (False, True):
        got = P.periodic_runs(docs_of(rows), repeat_tails=tails).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(str(expected(r[0], r[1], tails)) for r in rows)
    assert P.periodic_runs(docs_of(rows).limit(0)).count() == 0


def test_very_long_text(spark, docs_of):
    r = P.periodic_runs(docs_of([(6, "a b " * 300_000, "en", "c"), (7, " ".join(str(i) for i in range(300_000)), "en", "c")])).orderBy("doc_id").collect()
    assert tuple(r[0])[1:6] == (1, 0, 600_000, 2, 300_000_000) and r[1].n_runs == 0
