"""SimHash near-duplicates with bit-sliced comparison.

1. Every text becomes a 64-bit fingerprint: majority bits of the XXH64 hashes of its word shingles.
2. Equal fingerprints collapse to one row, so groups of copies cost nothing further.
3. The 64 bits are cut into ``radius + 2`` blocks.  Two fingerprints that differ in at most ``radius``
   bits agree in at least two blocks, so each pair of blocks is a bucket key (32 bits at radius 2).
4. Within a bucket the fingerprints are stored as vertical bit planes.  A query's differing bits are
   added plane by plane to carry-save counters, one bit of each counter per fingerprint, and a query's
   block is abandoned once every counter exceeds the radius.  Only a spanning forest of the links
   leaves the task.  Buckets over ``tile`` fingerprints are cut into chunks, and every pair of chunks
   is compared in a task of its own: nothing is dropped.
5. Components come from alternating star contraction over the forest edges.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import fresh, groups, map_rows, utf8
from .components import connected

U64 = np.uint64
FULL = U64(0xFFFFFFFFFFFFFFFF)


def simhash64(data: bytes, shingle: int = 3) -> int:
    """Fingerprint of a UTF-8 text as a signed 64-bit integer; 0 when it has no word."""
    words = data.lower().split()
    if not words:
        return 0
    parts = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(parts), 16384):
        some = parts[at:at + 16384]
        h = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(42)), np.uint64, len(some))
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(parts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) per row of ``docs``; ``text_hash`` tells rows with equal ids apart."""
    src = docs.select(qcol(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t"),
                      F.xxhash64(qcol(text_col)).alias("text_hash"))
    arrow = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])
    return map_rows(src, "doc_id long, text_hash long, fp long", arrow,
                    lambda: lambda r: (r[0], r[2], simhash64(r[1], shingle)))


def _exceeds(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Which counters, given as bit planes, hold more than ``radius``."""
    more, equal = over.copy(), ~over
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            more |= equal & counter[k]
            equal &= ~counter[k]
    return more


def within_radius(queries: np.ndarray, pool: np.ndarray, radius: int) -> np.ndarray:
    """Boolean matrix (queries x pool): at most ``radius`` differing bits."""
    words = -(-len(pool) // 64)
    bits = np.unpackbits(pool.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((64, words * 64), np.uint8)
    padded[:, :len(pool)] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8").astype(U64)
    out = np.zeros((len(queries), len(pool)), bool)
    width = radius.bit_length()
    live = np.arange(len(queries))
    counter = [np.zeros((len(queries), words), U64) for _ in range(width)]
    over = np.zeros((len(queries), words), U64)
    if len(pool) % 64:
        over[:, -1] = FULL << U64(len(pool) % 64)          # the padding never counts as near
    flip = lambda p: (U64(0) - (queries[live] >> U64(p) & U64(1)))[:, None]
    for p in range(0, 64, 2):
        x, y = planes[p] ^ flip(p), planes[p + 1] ^ flip(p + 1)
        if width:                                          # carry-save step: counter bit 0 and two planes at once
            c = counter[0]
            carry = (x & y) | (c & (x ^ y))
            counter[0] = c ^ x ^ y
            for k in range(1, width):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
        else:
            over |= x | y
        if p % 8 == 6:
            stay = ~(_exceeds(counter, over, radius) == FULL).all(axis=1)
            if not stay.all():                             # abandon what is all beyond the radius
                live, over = live[stay], over[stay]
                counter = [c[stay] for c in counter]
                if not len(live):
                    return out
    near = ~_exceeds(counter, over, radius)
    out[live] = np.unpackbits(near.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :len(pool)].astype(bool)
    return out


def forest(fps: np.ndarray, radius: int, step: int = 128) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints, as pairs of positions."""
    left, edges = np.arange(len(fps)), []
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            rows, wave = wave[:step], wave[step:]
            near = within_radius(fps[rows], fps[left], radius)
            got = near.any(axis=0)
            if got.any():
                edges += zip(rows[near.argmax(axis=0)[got]].tolist(), left[got].tolist())
                wave, left = np.concatenate([wave, left[got]]), left[~got]
    return edges


def near_links(fps: DataFrame, radius: int = 2, tile: int = 8192) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``fp`` within ``radius`` bits."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    block = [F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1)) for i in range(n)]
    keys = F.array(*[F.struct(F.lit(k).cast("short").alias("pair"), F.shiftleft(block[i], 32).bitwiseOR(block[j]).alias("v"))
                     for k, (i, j) in enumerate(combinations(range(n), 2))])
    rows = fps.select("fp", F.explode(keys).alias("key")).select("key.pair", "key.v", "fp")
    crowd = rows.groupBy("pair", "v").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / tile).cast("int")
    rows = (rows.join(crowd, ["pair", "v"])
            .withColumn("c", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("pair", "v", F.least("c", "o").alias("lo"), F.greatest("c", "o").alias("hi"), "fp"))
    by = ["pair", "v", "lo", "hi"]
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        for _, members in groups(batches, len(by)):
            signed = np.array([m[0] for m in members], np.int64)
            pairs = forest(signed.view(U64), radius)
            if pairs:
                i, j = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(signed[i]), pa.array(signed[j])], schema=arrow)

    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(compare, "a long, b long")


def labelled(prints: DataFrame, radius: int) -> DataFrame:
    """Adds ``component_id`` (smallest doc_id of the component, null if all its ids are null) to (doc_id, ..., fp)."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected(near_links(distinct.select("fp"), radius))
    of = (distinct.join(roots, distinct.fp == roots.node, "left")
          .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(of.join(ids, "root").select("fp", "component_id"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Null and wordless texts have fingerprint zero, linked like any other.  Rows with a null id take
    part; they never name a component.  Repeated rows are repeated in the result.  Other columns of
    ``docs`` are ignored, whatever their names.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    return labelled(prints, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  radius: int = 2) -> DataFrame:
    """``docs`` with one row left of each component: the smallest id (then text hash); of equal rows one.

    Columns are those of ``docs``.  A component whose ids are all null keeps its smallest text hash.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")).alias("w"))
    roots = connected(near_links(distinct.select("fp"), radius))
    i, h, bi, bh = fresh(docs, "_doc", "_hash", "_best_doc", "_best_hash")
    best = (distinct.join(roots, distinct.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("w").alias("w")).select(F.col("w.doc_id").alias(bi), F.col("w.text_hash").alias(bh)))
    mine = docs.withColumns({i: qcol(id_col).cast("long"), h: F.xxhash64(qcol(text_col))})
    same = F.col(i).eqNullSafe(F.col(bi)) & (F.col(h) == F.col(bh))
    return mine.join(best, same, "left_semi").dropDuplicates([i, h]).drop(i, h)
