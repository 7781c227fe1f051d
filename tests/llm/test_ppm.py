import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerflow.llm import ppm
from ledgerflow.llm.ppm_model import DISCOUNT, Trie, count_grams, grams

from .conftest import ODD


def slow_logs(train, text, order):
    """PPM with update-exclusion counts and symbol exclusion, symbol by symbol."""
    top = defaultdict(Counter)
    for t in train:
        s = b"\xff" * order + t + b"\xff"
        for i in range(order, len(s)):
            top[s[i - order:i]][s[i]] += 1
    ctx = {order: top}
    for k in range(order - 1, -1, -1):
        ctx[k] = defaultdict(Counter)
        for c, n in ctx[k + 1].items():
            for x in n:
                ctx[k][c[1:]][x] += 1
    out, s = 0.0, b"\xff" * order + text + b"\xff"
    for i in range(order, len(s)):
        gone = set()
        for k in range(order, -1, -1):
            n = {x: c for x, c in ctx[k].get(s[i - k:i], {}).items() if x not in gone}
            if not n:
                continue
            total = sum(n.values())
            if s[i] in n:
                out += math.log10((n[s[i]] - DISCOUNT) / total)
                break
            out += math.log10(DISCOUNT * len(n) / total)
            gone |= set(n)
        else:
            out += math.log10(1 / (256 - len(gone)))
    return out


@pytest.mark.parametrize("order", [0, 1, 2, 5])
def test_trie_equals_symbol_by_symbol_coding(order):
    train = [b"abracadabra", b"", b"banana band", "détente".encode()]
    code, n = count_grams(grams(train, order)[0])
    trie = Trie(code, n, order)
    for text in [b"abra", b"", b"zebra banana", b"\x00\x01", "é".encode()]:
        assert trie.logs(grams([text], order)[0]).sum() == pytest.approx(slow_logs(train, text, order), abs=1e-4)


def test_probabilities_of_a_context_add_up_to_one():
    code, n = count_grams(grams([b"abracadabra", b"abc"], 2)[0])
    trie = Trie(code, n, 2)
    for c in (b"ab", b"zz", b"\xff\xff", b"ra"):
        g = np.array([c[0] << 16 | c[1] << 8 | x for x in range(256)], np.uint64)
        assert (10 ** trie.logs(g)).sum() == pytest.approx(1, abs=1e-5)


def test_base_and_parts(spark, docs_of):
    rows = ODD + [(100 + i, f"alpha beta {i} gamma{i % 3}", "en", "a") for i in range(40)]
    df = docs_of(rows)
    got = ppm.ppm_scores(df, order=3, top_words=5).collect()
    learn = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    toks = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(w for r in learn for w in toks(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((r[0] or -1, len(toks(r[1])), sum(c[w] > 0 for w in toks(r[1])), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks(r[1])), 4)) for r in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    cut = ppm.ppm_scores(df, order=3, top_words=5, part_grams=20).collect()
    key = lambda x: sorted((r.doc_id or -1, round(r.score, 3)) for r in x)
    assert key(cut) == key(got)
    train = [(r[1] or "").encode().lower() for r in learn]
    for r in got:
        if r.doc_id in (3, 5, 105):
            text = next((x[1] or "") for x in rows if x[0] == r.doc_id)
            assert r.score == pytest.approx(slow_logs(train, text.encode().lower(), 3), abs=1e-3)
    assert ppm.ppm_scores(df.limit(0)).count() == 0
