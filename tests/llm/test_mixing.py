import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import mixing as M

from .conftest import ODD


def targets(sizes, weights=(3, 1, 2), share=1.5):
    """Targets by repeated sharing; None is the last source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        full = {s for s in open_ if left * w[s] / sum(w[x] for x in open_) >= 2 * sizes[s]}
        if not full:
            return out | {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_permutation(spark):
    for m in (1, 2, 7, 1000):
        got = [r[0] for r in spark.range(m).select(M.permuted(F.col("id"), F.lit(m), F.lit("k"), F.lit(1))).collect()]
        assert sorted(got) == list(range(m)) and (m < 1000 or got != list(range(m)))


def test_shares_of_the_mix(spark, docs_of):
    rng = np.random.default_rng(3)
    rows = ODD + [(100 + i, " ".join(["w"] * int(rng.integers(0, 400))), "en", ["a", "b", "c", "dé", None][int(rng.integers(0, 5))]) for i in range(400)]
    df = docs_of(rows)
    got = M.mix_sources(df, block=16).collect()
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((r[0] or -1, size(r[1])) for r in rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]} and mine[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in mine) == pytest.approx(want[s], rel=0.03, abs=32)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    again = M.mix_sources(df.repartition(7), block=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    texts = M.mixed_documents(df, block=16)
    assert texts.columns == df.columns
    taken = sum(r.taken for r in got)
    assert sum(size(r.text) for r in texts.collect()) == taken
    assert M.mix_sources(df.limit(0)).count() == 0 and M.mixed_documents(df.limit(0)).count() == 0
    wordless = df.where("text is null")
    assert [(r.taken, r.target) for r in M.mix_sources(wordless).collect()] == [(0, 0.0)]


def test_slots_hold_every_source_number_once(spark):
    t = spark.createDataFrame([(0, "=a", 1000, 1500.0), (1, "=b", 300, 600.0), (2, "", 64, 10.0)], "src int, key string, source_size long, target double")
    rows = M.drawn_blocks(t, block=10, shard_slots=32).collect()
    uses = {}
    for r in rows:
        uses[(r.src, r.block)] = uses.get((r.src, r.block), 0) + 1
    n = {s: sum(v for (x, _), v in uses.items() if x == s) for s in (0, 1, 2)}
    assert n == {0: 150, 1: 60, 2: 1} and len({r.slot for r in rows}) == 211
    assert set(uses[(1, b)] for b in range(30)) == {2} and set(uses[(0, b)] for b in range(100)) == {1, 2}
    by_shard = {r.shard: [x.src for x in rows if x.shard == r.shard].count(1) for r in rows if r.shard < 6}
    assert len(set(by_shard.values())) > 1             # random counts, not fixed quotas
