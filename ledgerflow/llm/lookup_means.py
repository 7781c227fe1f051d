"""k-means over integer vectors with scalar lookup tables.

1. Components become integers.  Vectors are packed into blocks of ``BLOCK_ROWS``; a block lists, per dimension, the
   integers that occur in it and keeps every component as a code into that list.  Blocks are written once.
2. A round sends the centroids out.  For each block, dimension, occurring integer and centroid the squared
   difference is tabulated once; the distance of a vector to all centroids is the sum of the table rows that its
   codes gather.  A table is bounded by the block, not by the data.
3. A task adds up the vectors of every cluster and returns one row per cluster, dimension and digit; Spark adds
   those, and new centroids (k x dimensions integers) are all that reaches the driver.

All arithmetic is exact: 32-bit or 64-bit where the largest possible sum fits, else Python integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage

BLOCK_ROWS = 8192
#: Vectors whose distances are summed at a time.
GATHER_ROWS = 1024
#: Sums travel as digits of this many bits, so that Spark can add them as longs.
DIGIT = 40

BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("sizes", pa.list_(pa.int32())), ("values", pa.binary())])


def whole_vector(vector: Column, dims: int, scale: float) -> Column:
    """Exactly ``dims`` components, none null, NaN or (times ``scale``) infinite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == F.lit(float("inf")))
    v = vector.cast("array<double>")
    return F.coalesce((F.size(v) == dims) & ~F.exists(v, bad), F.lit(False))


def packed_blocks(vectors: DataFrame, dims: int, scale: float) -> DataFrame:
    """Blocks (ids, codes, sizes, values) from (id long, v array<double>); values are floor(scale * v), exact as doubles."""

    def block(ids: list, x: np.ndarray) -> pa.RecordBatch:
        kinds, codes = zip(*(np.unique(column, return_inverse=True) for column in np.floor(x * scale).T))
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([np.stack(codes).astype("<u2").tobytes()], pa.binary()),
                                           pa.array([[len(k) for k in kinds]], pa.list_(pa.int32())),
                                           pa.array([np.concatenate(kinds).astype("<f8").tobytes()], pa.binary())], schema=BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                ids += some.column(0).to_pylist()
                parts.append(some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
                if len(ids) >= BLOCK_ROWS:
                    x = np.concatenate(parts)
                    yield block(ids[:BLOCK_ROWS], x[:BLOCK_ROWS])
                    ids, parts = ids[BLOCK_ROWS:], [x[BLOCK_ROWS:]]
        if ids:
            yield block(ids, np.concatenate(parts))

    return vectors.mapInArrow(run, "ids array<long>, codes binary, sizes array<int>, values binary")


def _integers(x: np.ndarray, kind: type) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python integers (``kind`` object)."""
    return np.array([int(v) for v in x], object) if kind is object else x.astype(np.int64)


def nearest(codes: np.ndarray, kinds: list[np.ndarray], centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) per vector; ``codes`` is dimensions x vectors.

    The smaller number wins a tie.  Distances are 64-bit, or Python integers for huge components.
    """
    high = max([abs(int(v)) for k in kinds for v in (k.min(), k.max())] + [abs(c) for row in centroids for c in row])
    most = len(kinds) * (2 * high) ** 2
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
    centres = np.array(centroids, object if kind is object else np.int64)            # k x dimensions
    tables = []
    for d, values in enumerate(kinds):
        apart = _integers(values, kind)[:, None] - centres[:, d][None, :]
        tables.append((apart * apart).astype(kind))
    label, least = [], []
    for at in range(0, codes.shape[1], GATHER_ROWS):
        part = codes[:, at:at + GATHER_ROWS]
        total = tables[0][part[0]]
        for d in range(1, len(tables)):
            total += tables[d][part[d]]
        best = total.argmin(axis=1)
        label.append(best)
        least.append(total[np.arange(len(best)), best])
    return np.concatenate(label), np.concatenate(least)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    for ids, codes, sizes, values in zip(*(c.to_pylist() for c in batch.columns)):
        yield ids, np.frombuffer(codes, "<u2").reshape(len(sizes), -1), np.split(np.frombuffer(values, "<f8"), np.cumsum(sizes)[:-1])


def _digits(n: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of the non-zero digits; all carry the sign."""
    sign, n, place = (-1 if n < 0 else 1), abs(n), 0
    while n:
        yield place, sign * (n & ((1 << DIGIT) - 1))
        n >>= DIGIT
        place += 1


def cluster_sums(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, dim, place, part): digits of the componentwise sums per cluster, pre-added per task; dim -1 holds counts."""
    arrow = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("place", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        k = len(centroids)
        for batch in batches:
            for _, codes, kinds in _opened(batch):
                label, _ = nearest(codes, kinds, centroids)
                for c, n in enumerate(np.bincount(label, minlength=k).tolist()):
                    sums[c, -1] = sums.get((c, -1), 0) + n
                for d, values in enumerate(kinds):
                    seen = np.bincount(label * len(values) + codes[d], minlength=k * len(values)).reshape(k, -1)
                    high = max(abs(int(values.min())), abs(int(values.max())))
                    exact = _integers(values, np.int64 if high * len(label) < 1 << 63 else object)
                    for c, s in enumerate((seen.astype(exact.dtype) @ exact).tolist()):
                        sums[c, d] = sums.get((c, d), 0) + s
        rows = [(c, d, place, part) for (c, d), s in sums.items() for place, part in _digits(s)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), arrow)], schema=arrow)

    made = blocks.mapInArrow(run, "cluster int, dim int, place int, part long")
    return made.groupBy("cluster", "dim", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after a round: floor(sum / count) of what was nearest; those nothing was nearest to stay."""
    sums: dict[tuple[int, int], int] = {}
    for r in cluster_sums(blocks, centroids).collect():      # clusters x dimensions x digits
        sums[r.cluster, r.dim] = sums.get((r.cluster, r.dim), 0) + (int(r.part) << DIGIT * r.place)
    return [[sums.get((c, d), 0) // sums[c, -1] for d in range(len(old))] if (c, -1) in sums else old for c, old in enumerate(centroids)]


def first_centroids(vectors: DataFrame, n: int, k: int, salt: str, scale: float) -> list[list[int]]:
    """The k vectors of (id, v) with the smallest sha256 of ``<salt><id>``; ``n`` vectors have an id.

    Only ids whose hash lies in the lowest share that holds about 8 k of them compete; the share grows until it holds k.
    """
    hashed = vectors.where("id is not null").select(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256).alias("h"), "v")
    share = min(1.0, 8 * k / max(n, 1))
    while True:
        some = hashed if share >= 1 else hashed.where(F.col("h") < f"{int(share * (1 << 60)):015x}")
        rows = some.orderBy("h", "v").limit(k).collect()
        if len(rows) >= k or share >= 1:
            return [[int(x) for x in np.floor(np.array(r.v) * scale)] for r in rows]
        share = min(1.0, share * 8)


def assigned(blocks: DataFrame, centroids: list[list[int]], id_name: str) -> DataFrame:
    """(id, cluster, distance) per vector; a distance that is no long is null."""
    arrow = pa.schema([(id_name, pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, codes, kinds in _opened(batch):
                label, least = nearest(codes, kinds, centroids)
                if least.dtype == object:
                    least = [x if x < 1 << 63 else None for x in least]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(label, pa.int32()), pa.array(least, pa.int64())], schema=arrow)

    return blocks.mapInArrow(run, f"`{id_name}` long, cluster int, distance long")


def lookup_means(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: float = 256.0,
                 k: int = 40, rounds: int = 5, salt: str = "2:") -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, have another length or hold null or non-finite components are left out; a component x
    becomes floor(``scale`` * x), ``scale`` being a power of two (beyond a double it counts as non-finite).  The first centroids are the ``k`` vectors with the
    smallest sha256 of ``salt`` and id (fewer if there are fewer); rows of equal id compete by their components, rows
    with a null id take part but never start a centroid.  After ``rounds`` rounds all are assigned once more.  Ties go
    to the smaller cluster number.  Repeated rows are vectors of their own.  If no id is known there is no centroid and
    no row.  Distances or sums beyond a long are null.  Other columns are ignored, whatever their names.
    """
    v = vectors.select(qcol(id_col).cast("long").alias("id"), qcol(vector_col).cast("array<double>").alias("v")).where(whole_vector(F.col("v"), dims, scale))
    blocks = cut_lineage(packed_blocks(v, dims, scale))
    n = int(blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0])
    centroids = first_centroids(v, n, k, salt, scale)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], out)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    rows = cut_lineage(assigned(blocks, centroids, "vec_id"))
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.try_sum("distance"))
    sums = {r.cluster: r.s for r in rows.groupBy("cluster").agg(whole.alias("s")).collect()}       # one row per cluster
    total = None if None in sums.values() else sum(sums.values())
    facts = vectors.sparkSession.createDataFrame(
        [(c, s, total if total is not None and total < 1 << 63 else None, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, s in sorted(sums.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
