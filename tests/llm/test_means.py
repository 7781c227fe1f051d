import hashlib
import math

import numpy as np

from ledgerflow.llm import lookup_means as L

SCHEMA = "vec_id long, embedding array<double>, label int, id int, v string, cluster string"


def plain(rows, k, rounds, dims):
    """Whole algorithm in Python integers; rows (id, vector) with distinct ids."""
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in last if m == n) for _, _, n in last}
    fit = lambda x: x if x < 1 << 63 else None
    whole = all(d < 1 << 63 for _, d, _ in last)
    return sorted([(i, n, fit(d), fit(inertia[n]), fit(sum(inertia.values())) if whole else None,
                    hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, d, n in last], key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0, 1, "v", "c") for i, v in rows], SCHEMA)
    got = L.lookup_means(df, **kw)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def test_rounds_equal_plain_integers(spark, monkeypatch):
    monkeypatch.setattr(L, "GATHER_ROWS", 7)
    rng = np.random.default_rng(0)
    rows = [(int(i), rng.normal(size=5).tolist()) for i in rng.permutation(300)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(200)]                                    # a third are copies
    rows += [(None, rows[0][1]), (2000, None), (2001, [1.0]), (2002, [0.1] * 4 + [None]), (2003, [0.1] * 4 + [math.nan]),
             (2004, [0.1] * 4 + [-math.inf]), (2005, []), (2006, [0.0] * 5), (2007, [-0.0] * 5)]
    assert run(spark, rows, dims=5, k=7, rounds=4) == plain(rows, 7, 4, 5)


def test_ties_few_vectors_and_empty(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(9)]                                         # copies: equal centroids, empty clusters
    assert run(spark, rows, dims=2, k=6, rounds=3) == plain(rows, 6, 3, 2)
    assert run(spark, rows[:3], dims=2, k=40, rounds=5) == plain(rows[:3], 40, 5, 2)
    assert run(spark, [], dims=2) == [] and run(spark, [(None, [1.0, 2.0]), (1, None)], dims=2) == []


def test_repeated_rows_are_vectors_of_their_own(spark):
    rows = [(i, [i / 10, -i / 7]) for i in range(20)]
    twice = run(spark, rows + rows[:1], dims=2, k=3, rounds=2)
    assert len(twice) == 21 and sum(r[0] == 0 for r in twice) == 2 and twice.count(twice[0]) in (1, 2)


def test_huge_components_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.integers(-3, e)).tolist()) for e in (7, 30, 280) for i in range(40 * e, 40 * e + 30)]
    rows += [(1, [1e307, 0.0, 0.0])]                                                            # 256 times it is no double
    for part in (rows[:30], rows[:60], rows):
        assert run(spark, part, dims=3, k=4, rounds=3) == plain(part, 4, 3, 3)


def test_codes_gather_the_same_distances():
    rng = np.random.default_rng(2)
    for scale in (1, 1 << 20, 1 << 40):
        x = rng.integers(-9, 9, (50, 6)) * scale
        kinds, codes = zip(*(np.unique(c.astype(float), return_inverse=True) for c in x.T))
        centres = (rng.integers(-9, 9, (4, 6)) * scale).tolist()
        label, least = L.nearest(np.stack(codes), list(kinds), centres)
        want = [min((sum((int(a) - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for v in x]
        assert [(int(d), int(n)) for d, n in zip(least, label)] == want
