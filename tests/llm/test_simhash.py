import numpy as np
import xxhash

from ledgerflow.llm import simhash as S

from .conftest import ODD


def plain(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, fps, radius=2):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        r = root(i)
        if x is not None:
            least[r] = min(x, least.get(r, x))
    return [least.get(root(i)) for i in range(len(fps))]


def test_bit_sliced_comparison_equals_popcount():
    rng = np.random.default_rng(0)
    for n, radius in ((1, 2), (63, 0), (64, 1), (65, 2), (300, 3), (130, 7)):
        base = rng.integers(0, 2**63, 4, dtype=np.uint64)
        fps = base[rng.integers(0, 4, n)] ^ np.array([sum(1 << int(b) for b in rng.permutation(64)[:rng.integers(0, 9)]) for _ in range(n)], np.uint64)
        got = S.within_radius(fps[:40], fps, radius)
        want = np.array([[bin(int(a ^ b)).count("1") <= radius for b in fps] for a in fps[:40]])
        assert (got == want).all()


def test_components_match_brute_force(spark, docs_of):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    rows = list(ODD)
    for i in range(60):
        t = [words[k] for k in rng.integers(0, 60, 200)]
        rows.append((100 + 3 * i, " ".join(t), "en", "a"))
        t[5] = "x"
        rows.append((101 + 3 * i, " ".join(t), "en", "a"))
    got = S.simhash_components(docs_of(rows)).collect()
    fps = {t: plain(t) for _, t, _, _ in rows}
    comp = components([r[0] for r in rows], [fps[r[1]] for r in rows])
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == sorted(
        (r[0] or -1, f"{fps[r[1]]:016x}", c) for r, c in zip(rows, comp))


def test_crowded_buckets_are_tiled_whole(spark):
    rng = np.random.default_rng(2)
    fps = list({int(0x0123456789ABCDEF ^ (1 << int(a)) ^ (1 << int(b))) for a, b in rng.integers(0, 20, (150, 2))})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = components(fps, fps)
    roots = {r.node: r.root for r in S.connected(S.near_links(df, 2, tile=16)).collect()}
    assert [roots.get(x, x) for x in fps] == want


def test_dedup_keeps_one_row_and_all_columns(spark, docs_of):
    df = docs_of(ODD)
    got = S.simhash_dedup(df)
    rows = got.collect()
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in rows) == [1, 2, 5, 6, 7, 7]
    assert S.simhash_dedup(df.limit(0)).count() == 0 and S.simhash_components(df.limit(0)).count() == 0
