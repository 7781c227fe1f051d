"""Regression forests on counted cells: one pass over the rows, then levels over distinct binned rows.

Splits are binned and every split sees all features, so rows that agree in all bins never part.  They become one cell
per tree, with the sum of their bootstrap weights and of weight x label.  A row's weight is drawn once per row and tree
(Poisson with mean 1; equal rows draw their common sum), as a function of seed, row and tree only, so reruns agree
under any partitioning.  Cells are dealt by blocks of trees and, where they are many, by chunks of cells.  A level is
one job: sums per (tree, node, feature, bin), dealt by node, and the best split of each node, which alone reaches the driver.

The result is Spark ML's own model: it is written where Spark ML writes one, and read back by it.  Cells are kept
without squares of the label, so the nodes' impurity is left unset (-1, as in Spark's own leaves); gain, weight and
prediction are there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage, scratch_path

#: Trees that share a row of the cell table.
BLOCK = 5
#: Up to here a cell's draws are summed one by one; beyond it, one Poisson draw with that mean.
ONE_BY_ONE = 8
#: A gain below this part of the sums it is the difference of is rounding.
ROUNDING = 1e-12
#: Nodes searched for their split at a time.
NODES = 1000


def thresholds(data: DataFrame, feats: list[str], max_bins: int) -> list[list[float]]:
    """Per feature the split points, at most ``max_bins`` - 1: between all neighbouring values if they are few, else quantiles."""
    probs = [k / max_bins for k in range(1, max_bins)]
    aggs = [a for i, c in enumerate(feats) for a in (F.approx_count_distinct(qcol(c)).alias(f"n{i}"), F.max(qcol(c)).alias(f"m{i}"),
                                                     F.percentile_approx(qcol(c), probs, 10_000).alias(f"q{i}"))]
    st = data.agg(*aggs).first()
    few = [i for i in range(len(feats)) if st[f"n{i}"] <= 2 * max_bins]
    sets = data.agg(*[F.collect_set(qcol(feats[i])).alias(f"s{i}") for i in few]).first() if few else None
    out = []
    for i in range(len(feats)):
        values = sorted(set(sets[f"s{i}"])) if i in few else []
        if i in few and len(values) <= max_bins:
            out.append([a + (b - a) / 2 for a, b in zip(values, values[1:])])
        else:
            out.append([q for q in sorted(set(st[f"q{i}"])) if q < st[f"m{i}"]])
    return out


def _binned(data: DataFrame, feats: list[str], cuts: list[list[float]]) -> DataFrame:
    """(b0, b1, ..., y): b is the number of split points below the value."""
    out = data
    for i, c in enumerate(feats):
        ends = [-math.inf, *[float(np.nextafter(x, math.inf)) for x in cuts[i]], math.inf]
        if cuts[i]:
            out = Bucketizer(splits=ends, inputCol=c, outputCol=f"_b{i}").transform(out)
        else:
            out = out.withColumn(f"_b{i}", F.lit(0))
    return out.select(*[F.col(f"_b{i}").cast("short").alias(f"b{i}") for i in range(len(feats))], F.col("_label").alias("y"))


def _poisson_ends() -> list[int]:
    """Of a uniform 32-bit number u: the Poisson(1) draw is the number of ends <= u."""
    total, term, out = 0.0, math.exp(-1.0), []
    for k in range(1, 14):
        total += term
        term /= k
        out.append(min(round(total * 2 ** 32), 2 ** 32 - 1))
    return sorted(set(out))


def bootstrap_weights(h: np.ndarray, m: np.ndarray, trees: int) -> np.ndarray:
    """Row by tree, the sum of m Poisson(1) draws, from the row's hash alone."""
    half = (trees + 1) // 2
    ends = [np.uint32(e) for e in _poisson_ends()]
    out = np.zeros((len(h), trees), np.int32)
    for k in range(min(int(m.max(initial=0)), ONE_BY_ONE)):
        at = np.flatnonzero((m > k) & (m <= ONE_BY_ONE))
        step = np.arange(k * half + 1, (k + 1) * half + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = h[at].view(np.uint64)[:, None] + step[None, :]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        u = (z ^ (z >> np.uint64(31))).view(np.uint32)[:, :trees]
        draw = np.zeros(u.shape, np.int8)
        for e in ends:
            draw += u >= e
        out[at] += draw
    for i in np.flatnonzero(m > ONE_BY_ONE):
        out[i] = np.random.Generator(np.random.Philox(key=int(h[i].view(np.uint64)))).poisson(m[i], trees)
    return out


def _cells(data: DataFrame, feats: list[str], cuts: list[list[float]], mean: float, trees: int, seed: int) -> DataFrame:
    """(block, b0, b1, ..., w, s): per block of trees and cell, the weights and weighted labels (less ``mean``) by tree.

    A cell whose rows lie in several partitions has a row from each."""
    bins = [f"b{i}" for i in range(len(feats))]
    rows = _binned(data, feats, cuts).groupBy(*bins, "y").agg(F.count(F.lit(1)).alias("m"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), *bins, "y")).withColumn("y", F.col("y") - F.lit(mean))
    parts = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *bins, "y")                # a large cell is split by label
    blocks = -(-trees // BLOCK)

    def sums(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        b = np.stack([t[c].to_numpy() for c in bins], axis=1)
        y, m, h = t["y"].to_numpy(), t["m"].to_numpy(), t["h"].to_numpy()
        order = np.lexsort((h, y, *b.T[::-1]))
        b, y, m, h = b[order], y[order], m[order], h[order]
        starts = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]).any(axis=1)])
        step = 1 << 14
        for lo in range(0, len(y), step):                            # a cell cut here has a row from either side
            cut = np.unique(np.r_[lo, starts[(starts >= lo) & (starts < lo + step)]])
            wt = bootstrap_weights(h[lo:lo + step], m[lo:lo + step], trees)
            w = np.add.reduceat(wt, cut - lo, axis=0)
            s = np.add.reduceat(wt * y[lo:lo + step, None], cut - lo, axis=0)
            n = len(cut)
            wide_w, wide_s = np.zeros((n, blocks * BLOCK), np.int32), np.zeros((n, blocks * BLOCK))
            wide_w[:, :trees], wide_s[:, :trees] = w, s
            ends = np.arange(0, n * blocks * BLOCK + 1, BLOCK, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(blocks, dtype=np.int32), n)), *[pa.array(np.repeat(c, blocks)) for c in b[cut].T],
                 pa.ListArray.from_arrays(ends, wide_w.ravel()), pa.ListArray.from_arrays(ends, wide_s.ravel())],
                names=["block", *bins, "w", "s"])

    return rows.mapInArrow(sums, "block int, " + ", ".join(f"{c} short" for c in bins) + ", w array<int>, s array<double>")


class Tree:
    """A tree as it grows: per node the split (feature -1: none yet), the first of two neighbouring children, weight, sum, gain."""

    def __init__(self):
        self.feature, self.cut, self.left, self.weight, self.total, self.gain = [-1], [-1], [-1], [0.0], [0.0], [-1.0]
        self.open = [0]

    def split(self, node: int, feature: int, cut: int, gain: float, w: float, s: float, wl: float, sl: float) -> list[int]:
        """The node's two children; none if ``feature`` is -1."""
        self.weight[node], self.total[node] = w, s
        if feature < 0:
            return []
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, at, gain
        for cw, cs in ((wl, sl), (w - wl, s - sl)):
            for values, x in zip((self.feature, self.cut, self.left, self.weight, self.total, self.gain), (-1, -1, -1, cw, cs, -1.0)):
                values.append(x)
        return [at, at + 1]

    def state(self) -> tuple:
        slot = np.full(len(self.feature), -1, np.int64)
        slot[self.open] = np.arange(len(self.open))
        return np.array(self.feature, np.int16), np.array(self.cut, np.int16), np.array(self.left, np.int32), slot, np.array(self.open, np.int64)


def _nodes_of(feature, cut, left, bins: np.ndarray) -> np.ndarray:
    node, moving = np.zeros(len(bins), np.int32), np.arange(len(bins))
    while True:
        f = feature[node[moving]]
        moving, f = moving[f >= 0], f[f >= 0]
        if not len(moving):
            return node
        at = node[moving]
        node[moving] = left[at] + (bins[moving, f] > cut[at])


def _level(cells: DataFrame, trees: dict[int, Tree], d: int, width: int, parts: int) -> DataFrame:
    """(node, feature, cut, gain, w, s, wl, sl) of every open node; node is tree << 32 | node, feature -1: no split."""
    state = cells.sparkSession.sparkContext.broadcast({t: tree.state() for t, tree in trees.items()})

    def histograms(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        bins = np.stack([t[f"b{i}"].to_numpy() for i in range(d)], axis=1)
        block = t["block"].to_numpy()
        w = t["w"].combine_chunks().flatten().to_numpy().reshape(-1, BLOCK)
        s = t["s"].combine_chunks().flatten().to_numpy().reshape(-1, BLOCK)
        for k in np.unique(block):
            here = np.flatnonzero(block == k)
            for j in range(BLOCK):
                if int(k) * BLOCK + j not in state.value:
                    continue
                feature, cut, left, slot, open_ = state.value[int(k) * BLOCK + j]
                rows = here[w[here, j] > 0]
                at = slot[_nodes_of(feature, cut, left, bins[rows])]
                rows, at = rows[at >= 0], at[at >= 0]
                if not len(rows):
                    continue
                x = ((at * d)[:, None] + np.arange(d)) * width + bins[rows]
                size = len(open_) * d * width
                ws = np.bincount(x.ravel(), np.repeat(w[rows, j], d), size)
                ss = np.bincount(x.ravel(), np.repeat(s[rows, j], d), size)
                got = np.flatnonzero(ws)
                node = (np.int64(int(k) * BLOCK + j) << 32) | open_[got // (d * width)]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array((got % (d * width)).astype(np.int32)), pa.array(ws[got]),
                                                  pa.array(ss[got])], names=["node", "fb", "w", "s"])

    def best(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        order = np.lexsort((t["s"].to_numpy(), t["node"].to_numpy()))
        ids, at = np.unique(t["node"].to_numpy()[order], return_inverse=True)
        fb, w, s = (t[c].to_numpy()[order] for c in ("fb", "w", "s"))
        for lo in range(0, len(ids), NODES):
            hi = min(lo + NODES, len(ids))
            a, b = np.searchsorted(at, [lo, hi])
            x, size = (at[a:b] - lo) * (d * width) + fb[a:b], (hi - lo) * d * width
            ws = np.bincount(x, w[a:b], size).reshape(-1, d, width)
            wl = ws.cumsum(axis=2)
            sl = np.bincount(x, s[a:b], size).reshape(-1, d, width).cumsum(axis=2)
            wt, st = wl[:, :, -1:], sl[:, :, -1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                parted, whole = sl * sl / wl + (st - sl) ** 2 / (wt - wl), st * st / wt
                gain = np.where((ws > 0) & (wl < wt) & (parted - whole > ROUNDING * (parted + whole)), parted - whole, -1.0)
            gain = gain.reshape(hi - lo, -1)
            top = gain.argmax(axis=1)
            n = np.arange(hi - lo)
            gain, pick = gain[n, top], lambda v: v.reshape(hi - lo, -1)[n, top]
            total_w, total_s = wt[:, 0, 0], st[:, 0, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo:hi]), pa.array(np.where(gain > 0, top // width, -1).astype(np.int32)), pa.array((top % width).astype(np.int32)),
                 pa.array(gain / total_w), pa.array(total_w), pa.array(total_s), pa.array(pick(wl)), pa.array(pick(sl))],
                names=["node", "feature", "cut", "gain", "w", "s", "wl", "sl"])

    sums = cells.mapInArrow(histograms, "node long, fb int, w double, s double")
    return sums.repartition(parts, "node").mapInArrow(
        best, "node long, feature int, cut int, gain double, w double, s double, wl double, sl double")


def _grow(cells: DataFrame, num_trees: int, max_depth: int, d: int, width: int, parts: int) -> list[Tree]:
    trees = [Tree() for _ in range(num_trees)]
    for depth in range(max(max_depth, 1)):
        open_ = {t: tree for t, tree in enumerate(trees) if tree.open}
        if not open_:
            break
        found = _level(cells, open_, d, width, parts).toArrow().sort_by("node").to_pydict()        # a row per open node
        for tree in open_.values():
            tree.open = []
        for node, feature, *rest in zip(*found.values()):
            tree = trees[node >> 32]
            tree.open += tree.split(node & 0xFFFFFFFF, feature if max_depth else -1, *rest)
        for tree in open_.values():                                   # one row's worth of weight can't be split
            tree.open = [k for k in tree.open if tree.weight[k] > 1]
    return trees


def _write_nodes(spark, trees: list[Tree], cuts: list[list[float]], mean: float, path: str) -> None:
    """The nodes as the rows that Spark ML keeps of a forest, in place of the one-node trees at ``path``."""
    data = f"{path}/data"
    schema = spark.read.parquet(data).schema
    sizes = [len(t.feature) for t in trees]
    flat = lambda name, kind: np.concatenate([np.array(getattr(t, name), kind) for t in trees])
    feature, cut, left, w, s = flat("feature", np.int32), flat("cut", np.int32), flat("left", np.int32), flat("weight", float), flat("total", float)
    gain = flat("gain", float)
    value = np.divide(s, w, out=np.zeros_like(s), where=w > 0) + mean
    points = [[cuts[f][c]] if f >= 0 else [] for f, c in zip(feature.tolist(), cut.tolist())]
    stats = np.stack([w, value * w, np.zeros_like(w)], axis=1)
    nodes = pa.table({
        "treeID": np.repeat(np.arange(len(trees), dtype=np.int32), sizes), "id": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
        "prediction": value, "stats": pa.ListArray.from_arrays(np.arange(0, 3 * len(w) + 1, 3, dtype=np.int32), stats.ravel()),
        "rawCount": w.astype(np.int64), "gain": gain, "leftChild": left, "rightChild": np.where(left >= 0, left + 1, -1).astype(np.int32),
        "feature": feature, "points": pa.array(points, pa.list_(pa.float64()))})
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("points").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    rows = spark.createDataFrame(nodes).select("treeID", F.struct(
        "id", "prediction", F.lit(-1.0).alias("impurity"), F.col("stats").alias("impurityStats"), "rawCount", "gain", "leftChild", "rightChild",
        split.alias("split")).alias("nodeData"))
    rows.select(*[qcol(f.name).cast(f.dataType) for f in schema.fields]).write.mode("overwrite").parquet(data)


def fit_forest(data: DataFrame, feats: list[str], num_trees: int, max_depth: int, seed: int, max_bins: int, memory_mb: int) -> PipelineModel:
    """A forest on the columns ``feats`` and ``_label`` (doubles without gaps; a null or NaN label is an error)."""
    spark = data.sparkSession
    data = data.select(*[qcol(c) for c in feats], "_label").persist()
    try:
        st = data.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_label").isNull() | F.isnan("_label")).alias("bad"),
                      F.avg("_label").alias("mean")).first()
        if not st["n"]:
            raise ValueError("no rows to train on")
        if st["bad"]:
            raise ValueError("labels must not be null or NaN")
        cuts = thresholds(data, feats, max_bins)
        cells = cut_lineage(_cells(data, feats, cuts, st["mean"], num_trees, seed))
    finally:
        data.unpersist()
    blocks, d = -(-num_trees // BLOCK), len(feats)
    held = memory_mb * (1 << 20) // 16 // (BLOCK * 12 + 2 * d + 4)        # cells a task holds, with what it computes from them
    chunks = -(-cells.count() // (blocks * held)) or 1
    slot = F.col("block") * chunks + F.pmod(F.xxhash64(*[f"b{i}" for i in range(d)]), F.lit(chunks))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(max(parts, blocks * chunks), slot).persist()
    try:
        trees = _grow(cells, num_trees, max_depth, d, max(len(c) for c in cuts) + 1, parts)
    finally:
        cells.unpersist()
    assembler = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    rf = RandomForestRegressor(featuresCol="features", labelCol="_label", numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="all",
                               subsamplingRate=1.0, seed=seed, maxBins=max_bins, bootstrap=True, maxMemoryInMB=memory_mb)
    alike = spark.createDataFrame([(Vectors.dense([0.0] * d), 0.0)] * 2, ["features", "_label"])
    path = scratch_path(spark, "forest")
    rf.fit(alike).write().save(path)                                  # trees of one node: Spark's parameters and layout
    _write_nodes(spark, trees, cuts, st["mean"], path)
    return PipelineModel([assembler, RandomForestRegressionModel.load(path)])
