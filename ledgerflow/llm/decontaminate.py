"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``least`` words, of items that are shorter the whole item.  A bitmap of fixed size of all benchmark seeds is broadcast; document seeds
that pass it are joined with the benchmark's seeds.  Pairs whose shared seeds cover enough of the item (an
upper bound of what tiles can cover) are tiled, and the item's share of tiled words is held against the
threshold.  Tiles may come in any order, which finds reordered passages.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import fresh, rows_of, table, utf8
from .tiling import U64, tiles, windows

#: ASCII that is neither letter nor digit parts words.
PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Scripts without spaces (Thai, Lao, Myanmar, Khmer, kana, Han): each character is a word; their punctuation parts words.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
MARKS = re.compile("[\u3000-\u3004\u3008-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
#: Bits of the seed bitmap; two are set per seed.
BITMAP = 26


def words(data: bytes) -> list[bytes]:
    text = data.decode("utf-8", "replace").lower()
    if not data.isascii():
        text = UNSPACED.sub(r" \g<0> ", MARKS.sub(" ", text))
    return text.encode().translate(PLAIN).split()


def token_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, ws), U64, len(ws))


def _bits(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = seeds * U64(0xD6E8FEB86659FD93)
    return (mixed >> U64(64 - BITMAP)).astype(np.int64), ((seeds ^ mixed >> U64(29)) * U64(0xCA4BCAA75EC3F625) >> U64(64 - BITMAP)).astype(np.int64)


def _items(benchmark: DataFrame, id_col: str, text_col: str, least: int, least_item: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Item ids (item_id, key), texts (key, n, item words joined) and seeds (seed, key, pos, n); a key is a distinct text."""
    arrow = pa.schema([("item_id", pa.int64()), ("n", pa.int32()), ("item", pa.binary())])

    def norm(batches):
        for b in batches:
            yield table([(i, len(ws), b" ".join(ws)) for i, t in rows_of(b) if len(ws := words(t)) >= max(least_item, 1)], arrow)

    src = benchmark.select(qcol(id_col).cast("long").alias("item_id"), utf8(text_col).alias("t"))
    ids = cut_lineage(src.mapInArrow(norm, "item_id long, n int, item binary").withColumn("key", F.xxhash64("item")))
    texts = ids.select("key", "n", "item").dropDuplicates(["key"])
    out = pa.schema([("seed", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])

    def seeds(batches):
        for b in batches:
            for key, n, item in rows_of(b):
                s = windows(token_hashes(item.split()), min(least, n)).view(np.int64)
                yield table([(int(x), key, p, n) for p, x in enumerate(s)], out)

    return ids.select("item_id", "key"), texts, cut_lineage(texts.mapInArrow(seeds, "seed long, key long, pos int, n int"))


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The bitmap of all seeds; the driver receives at most 2**BITMAP / 64 words of 64 bits."""
    arrow = pa.schema([("word", pa.int32()), ("bits", pa.int64())])

    def run(batches):
        for b in batches:
            s = b.column(0).to_numpy(zero_copy_only=False).view(U64)
            at = np.concatenate(_bits(s))
            yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int32)), pa.array((U64(1) << (at & 63).astype(U64)).view(np.int64))], schema=arrow)

    got = seeds.select("seed").mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << BITMAP - 6, U64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy().view(U64)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", least: int = 5, coverage: float = 0.6, least_item: int = 1) -> DataFrame:
    """Pairs of a document and a benchmark item of whose words tiles of ``least`` or more words cover ``coverage`` or more.

    One tile of ``least`` words is not enough for an item of more words, and an item of fewer words must be in
    the document as a whole.  Items of fewer than ``least_item`` words are left out.

    Returns doc_id, text_hash (xxhash64 of the document's text), item_id, coverage, n_tiles and tiles
    array<struct<doc_pos, item_pos, length>> in words, one row per pair of rows.  Words are compared in lower
    case without punctuation; in scripts without spaces each character is a word.  Null or empty texts match
    nothing; null ids are returned as null; repeated rows on either side each give a row.  Other columns are ignored,
    whatever their names.
    """
    ids, texts, seeds = _items(benchmark, item_col, item_text_col, least, least_item)
    sizes = sorted(r[0] for r in texts.select(F.least("n", F.lit(least))).distinct().collect())         # ``least`` rows at most
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))
    arrow = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("doc", pa.binary()), ("seeds", pa.list_(pa.int64()))])

    def probe(batches):
        bitmap = shared.value

        def has(at: np.ndarray) -> np.ndarray:
            return (bitmap[at >> 6] >> (at & 63).astype(U64) & U64(1)).astype(bool)

        for b in batches:
            out = []
            for doc_id, h, t in rows_of(b):
                ws = words(t)
                hashes = token_hashes(ws)
                s = np.concatenate([windows(hashes, k) for k in sizes] or [np.zeros(0, U64)])
                x, y = _bits(s)
                hit = has(x)
                hit[hit] = has(y[hit])
                if hit.any():
                    out.append((doc_id, h, b" ".join(ws), np.unique(s[hit]).view(np.int64)))
            yield table(out, arrow)

    src = docs.select(qcol(id_col).cast("long").alias("doc_id"), F.xxhash64(qcol(text_col)).alias("text_hash"), utf8(text_col).alias("t"))
    found = src.mapInArrow(probe, "doc_id long, text_hash long, doc binary, seeds array<long>")
    found = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))
    # words that shared seeds cover: each adds ``least`` or the distance to the next one
    covered = F.aggregate(F.array_sort(F.collect_set("pos")), F.struct(F.lit(-least).alias("end"), F.lit(0).alias("sum")),
                          lambda s, p: F.struct(p.alias("end"), (s["sum"] + F.least(p - s["end"], F.lit(least))).alias("sum")), lambda s: s["sum"])
    pairs = (found.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy("row", "key", "n")
             .agg(covered.alias("most")).where(F.col("most") >= F.col("n") * F.lit(coverage))
             .where((F.col("most") > least) | (F.col("n") <= least)).select("row", "key"))
    work = pairs.join(found.select("row", "doc_id", "text_hash", "doc"), "row").join(texts, "key").select("doc_id", "text_hash", "key", "doc", "item")
    tile = pa.struct([("doc_pos", pa.int32()), ("item_pos", pa.int32()), ("length", pa.int32())])
    made = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(tile))])

    def run(batches):
        for b in batches:
            out = []
            for doc_id, h, key, doc, item in rows_of(b):
                d, p = doc.split(), item.split()
                names = {w: k for k, w in enumerate({*d, *p})}
                x, y = (np.array([names[w] for w in ws], U64) for ws in (d, p))
                got = tiles(x, y, min(least, len(p)))
                tiled = sum(n for _, _, n in got)
                share = tiled / len(p)
                if share >= coverage and (tiled > least or tiled == len(p)):
                    out.append((doc_id, h, key, share, [{"doc_pos": i, "item_pos": j, "length": n} for i, j, n in got]))
            yield table(out, made)

    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    got = work.repartition(spread).mapInArrow(run, "doc_id long, text_hash long, key long, coverage double, "
                                                   "tiles array<struct<doc_pos: int, item_pos: int, length: int>>")
    return got.join(ids, "key").select("doc_id", "text_hash", "item_id", "coverage", F.size("tiles").alias("n_tiles"), "tiles")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_item: int = 8,
                      **settings) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that hold no benchmark item of ``least_item`` or more words.

    A shorter item is a word or phrase that clean documents hold too; ``contaminated`` reports it, no document goes for it.
    """
    i, h, bi, bh = fresh(docs, "_doc", "_hash", "_bad_doc", "_bad_hash")
    bad = cut_lineage(contaminated(docs, benchmark, id_col, text_col, least_item=least_item, **settings)
                      .select(F.col("doc_id").alias(bi), F.col("text_hash").alias(bh)).distinct())
    mine = docs.withColumns({i: qcol(id_col).cast("long"), h: F.xxhash64(qcol(text_col))})
    return mine.join(bad, F.col(i).eqNullSafe(F.col(bi)) & (F.col(h) == F.col(bh)), "left_anti").drop(i, h)
