import numpy as np
import pytest

from ledgerflow.llm import decontaminate as D
from ledgerflow.llm import langid, toxicity
from ledgerflow.llm.tiling import tiles, windows, _rolled

from .conftest import ODD


def slow_tiles(a, b, least):
    """Greedy string tiling by direct comparison: always the longest run of unmarked equal tokens next."""
    ma, mb, out = [False] * len(a), [False] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not ma[i + k] and not mb[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if n < least:
            return out
        out += n
        ma[i:i + n] = mb[j:j + n] = [True] * n


def test_tiling_equals_direct_comparison():
    rng = np.random.default_rng(0)
    for n, kinds, least in ((30, 3, 2), (40, 2, 3), (25, 8, 1), (60, 5, 4)):
        for _ in range(15):
            a, b = rng.integers(0, kinds, n), rng.integers(0, kinds, n // 2)
            got = tiles(a.astype(np.uint64), b.astype(np.uint64), least)
            assert all((a[i:i + k] == b[j:j + k]).all() and k >= least for i, j, k in got)
            assert sum(k for *_, k in got) == pytest.approx(slow_tiles(a.tolist(), b.tolist(), least), abs=2 * least)
    t = rng.integers(0, 9, 100).astype(np.uint64)
    assert all((windows(t, k) == _rolled(t, k)).all() for k in (1, 2, 3, 7, 32))


def test_contamination_finds_reordered_passages(spark, docs_of):
    item = "one two three four five six. Seven eight nine ten eleven, twelve thirteen fourteen fifteen sixteen"
    w = item.split()
    rows = ODD + [(20, "before " + item.upper() + " after", "en", "a"), (21, " ".join(w[8:] + ["gap"] + w[:8]), "en", "a"),
                  (22, " ".join(w[:6]) + " other words here", "en", "a"), (20, item, "en", "b")]
    bench = spark.createDataFrame([(1, item, 0), (2, item, 0), (3, None, 0), (4, "too short", 0), (None, "", 0)], "item_id long, text string, doc_id int")
    got = D.contaminated(docs_of(rows), bench)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(20, 1), (20, 1), (20, 2), (20, 2), (21, 1), (21, 2)]
    assert {r.doc_id: r.n_tiles for r in got.collect()} == {20: 1, 21: 2}
    kept = D.without_benchmark(docs_of(rows), bench)
    assert kept.columns == docs_of(rows).columns and kept.count() == len(rows) - 3
    assert D.contaminated(docs_of(rows).limit(0), bench).count() == 0 and D.contaminated(docs_of(rows), bench.limit(0)).count() == 0


def test_language_id(spark, docs_of):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(sf).join(sf.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98 and all(0 <= r.score <= 1 for r in got)
    odd = langid.identify(docs_of(ODD)).collect()
    assert sorted(r.doc_id or -1 for r in odd) == sorted(r[0] or -1 for r in ODD)
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {2, 3, 4, 5}
    kept = langid.keep_identified(docs_of(ODD))
    assert kept.columns == docs_of(ODD).columns and {r.doc_id for r in kept.collect()} <= {1, None, 6, 7}
    assert langid.identify(docs_of(ODD).limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs_of([(1, "abc", None, "a")])).collect()} == {"und"}
    for k in (2, 4, 6, 9, 20):
        code = langid.codewords(k)
        assert len({tuple(c) for c in code}) == k
        for i in range(k):                              # the nearest codeword survives a wrong bit of ten
            m = (2.0 * code[i] - 1) * 3
            m[:max(0, len(m) // 20)] *= -1
            assert langid.decode(m, code).argmin() == i


def brute_segments(scores):
    """All maximal scoring segments by recursion on the best segment (shortest, leftmost among equals)."""
    def rec(lo, hi):
        best = None
        for i in range(lo, hi):
            s = 0.0
            for j in range(i, hi):
                s += scores[j]
                if best is None or s > best[0] + 1e-12:
                    best = (s, i, j)
        if best is None or best[0] <= 1e-12:
            return []
        return rec(lo, best[1]) + [(best[1], best[2], best[0])] + rec(best[2] + 1, hi)
    return rec(0, len(scores))


def test_segments_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(0, 25))
        gain = np.where(rng.random(n) < 0.35, rng.random(n) * 3 + 0.01, 0.0)
        at = np.flatnonzero(gain).tolist()
        got = toxicity.segments(at, gain[at].tolist(), 0.37)
        want = brute_segments((gain - 0.37).tolist())
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_toxicity(spark, docs_of):
    d, y = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(d, y).join(y, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    marks = spark.createDataFrame([(1, 0), (7, 1), (7, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    odd = toxicity.toxicity(docs_of(ODD), marks).collect()
    assert sorted(r.doc_id or -1 for r in odd) == sorted(r[0] or -1 for r in ODD) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.toxicity(docs_of(ODD), marks.limit(0)).count() == len(ODD)
    assert toxicity.toxicity(docs_of(ODD).limit(0), marks).count() == 0


def test_extreme_value_constant(spark, docs_of, monkeypatch):
    lexicon, drift, lam = {b"bad": (2.0, 0.01), b"vile": (3.0, 0.002)}, 0.5, 1.3
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["bad", "vile", "calm", "sea"], p=[0.01, 0.002, 0.5, 0.488], size=n)) for n in rng.integers(1, 400, 60)] + ["", None]
    src = docs_of([(i, t, "en", "a") for i, t in enumerate(texts)]).selectExpr("doc_id", "true as learn", "coalesce(cast(text as binary), cast('' as binary)) as t")
    clean = spark.range(0, 62, 2).withColumnRenamed("id", "doc_id")
    want = []
    for t in texts[::2]:
        gain = [{"bad": 2.0, "vile": 3.0}.get(w, 0.0) for w in (t or "").split()]
        if gain:
            want.append(lam * max((s for *_, s in brute_segments([g - drift for g in gain])), default=0.0) - np.log(len(gain)))
    got = toxicity.extreme_constant(src, clean, lexicon, drift, lam)
    assert got == pytest.approx(np.mean(want) - np.euler_gamma, abs=1e-6)
    assert toxicity.extreme_constant(src, clean.limit(0), lexicon, drift, lam) == 0.0

    used, passages = [], toxicity.passages
    monkeypatch.setattr(toxicity, "passages", lambda *a: used.append(a[4:]) or passages(*a))
    d, y = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    toxicity.toxicity(d, y)
    assert len(used) == 2 and used[1][0] < 0 and used[1][1] == 1.0              # K < 1 reaches the scoring pass


def test_contamination_by_short_and_unspaced_items(spark, docs_of):
    han = "今天天气很好，我们一起去公园散步吧"
    rows = [(1, "He asked: who wrote Hamlet? Nobody knew.", "en", "a"), (2, "Hamlet wrote who", "en", "a"), (3, "at the end of the day we left", "en", "a"),
            (4, "At the end of the day, nothing matters.", "en", "a"), (5, "他说：" + han + "。", "zh", "a"), (6, "今天我们去学校", "zh", "a"), (7, None, "en", "a")]
    items = [(10, "Who wrote Hamlet?", 0), (11, "by the end of the day nothing works", 0), (12, han, 0), (13, "at the end of the", 0), (14, "", 0)]
    got = D.contaminated(docs_of(rows), spark.createDataFrame(items, "item_id long, text string, doc_id int")).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in got) == [(1, 10, 1.0), (3, 13, 1.0), (4, 11, 0.75), (4, 13, 1.0), (5, 12, 1.0)]


def test_pieces_of_pairs_change_nothing(monkeypatch):
    from ledgerflow.llm import tiling

    rng = np.random.default_rng(8)
    for _ in range(60):
        a, b = (rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint64) for _ in range(2))
        a[10:25] = 1
        whole = tiles(a, b, 3)
        monkeypatch.setattr(tiling, "PAIRS", int(rng.integers(1, 40)))
        assert tiles(a, b, 3) == whole
        monkeypatch.undo()


def test_repetitive_texts_fit_in_memory():
    import tracemalloc

    a, b = np.ones(300_000, np.uint64), np.concatenate([np.arange(2, 602), np.ones(40), np.arange(2, 602)]).astype(np.uint64)
    tracemalloc.start()
    got = tiles(a, b, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(0, 600, 40)] and peak < 400e6


def test_short_items_remove_no_document(spark, docs_of):
    rows = [(i, f"well that is document {i} on the other hand", "en", "a") for i in range(20)]
    items = spark.createDataFrame([(1, "that"), (2, "on the other hand"), (3, "well that is document 7 on the other hand")], "item_id long, text string")
    assert {r.item_id for r in D.contaminated(docs_of(rows), items).collect()} == {1, 2, 3}
    assert sorted(r.doc_id for r in D.without_benchmark(docs_of(rows), items).collect()) == [i for i in range(20) if i != 7]
