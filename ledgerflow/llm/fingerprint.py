"""SimHash document fingerprints and the search for near ones by permuted block tables.

A text's terms are its runs of ``TERM`` bytes, ASCII letters in lower case.  A term that occurs f times weighs
1 + ln f; every bit of its hash votes with that weight for 1 or -1, and the signs of the sums are the fingerprint.

Two fingerprints that differ in at most r bits agree in one of r + 1 blocks.  Table k holds all fingerprints with
their bytes permuted so that block k stands first, partitioned and sorted by it; a query meets those with the same
first block and counts what lies within the radius, each pair in the first table that both share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage
from .common import groups, map_rows, rows_of, small_side, table, utf8

#: Bytes of a term; shorter texts are one term.
TERM = 5
#: Terms whose bits are counted at a time.
STEP = 16_384
SEED = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_terms(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms as integers, and their weights in sixteenths."""
    a = np.frombuffer(data.lower(), np.uint8).astype(np.uint64)
    size = min(TERM, len(a))
    if not size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    x = np.full(len(a) - size + 1, size, np.uint64)
    for k in range(size):
        x = x << np.uint64(8) | a[k:len(a) - size + 1 + k]
    terms, f = np.unique(x, return_counts=True)
    return terms, np.floor(16 * (1 + np.log(f))).astype(np.int64)


def fingerprint(data: bytes, bits: int = 256) -> bytes:
    """Fingerprint of a UTF-8 text; all zero for an empty one.  Sums are exact, so equal texts always agree."""
    terms, weights = weighted_terms(data)
    votes = np.zeros(bits, np.int64)
    seeds = np.array([SEED * (k + 1) & WORD for k in range(bits // 64)], np.uint64)
    for at in range(0, len(terms), STEP):
        h = _mix(terms[at:at + STEP, None] + seeds[None, :]).astype("<u8").view(np.uint8)
        ones = np.unpackbits(h, axis=1).astype(np.float32)
        votes += (weights[at:at + STEP].astype(np.float32) @ ones).astype(np.int64)      # below 2**24: exact
    return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bits."""
    return 1.0 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / (8 * len(a))


class _Doc:
    """A document with its text and fingerprint."""

    def __init__(self, doc_id: int | None, data: bytes, bits: int):
        self.doc_id, self.data, self.text = doc_id, data, data.decode("utf-8", "replace")
        self.print = fingerprint(data, bits)

    def row(self, after: "_Doc", bits: int) -> tuple:
        n, k = len(self.text), len(self.text) // 3
        edited = (self.text[:n - k] + after.text[:k]).encode()
        ep = fingerprint(edited, bits)
        return (self.doc_id, n, hashlib.sha256(edited).hexdigest(), self.print, ep, likeness(self.print, ep), likeness(self.print, after.print))


FACTS = "doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.binary()), ("edited_fp", pa.binary()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256) -> DataFrame:
    """``FACTS`` per row: fingerprints of its text and of the text with its last third taken from the next document.

    Documents stand in descending id (then text hash) in range partitions, so a task has nearly every document's next
    one at hand.  The last document of each partition, left open with its text, meets the first one of the partition
    behind it in a join of one row per partition.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = (docs.select(qcol(id_col).cast("long").alias("doc_id"), F.xxhash64(qcol(text_col)).alias("h"), utf8(text_col).alias("t"))
           .repartitionByRange(n, F.col("doc_id").desc_nulls_last(), "h").sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "h", "t")
           .select(F.spark_partition_id().alias("part"), "doc_id", "t"))
    more = [("part", pa.int32()), ("head_id", pa.int64()), ("head", pa.binary()), ("tail", pa.binary())]
    arrow = pa.schema([*ARROW, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None
        for batch in batches:
            out = []
            for part, doc_id, data in rows_of(batch):
                doc = _Doc(doc_id, data, bits)
                if last is None:
                    head = doc
                else:
                    out.append((*last.row(doc, bits), part, None, None, None))
                last = doc
            yield table(out, arrow)
        if last is not None:
            yield table([(last.doc_id, *[None] * 6, part, head.doc_id, head.data, last.data)], arrow)

    made = cut_lineage(src.mapInArrow(run, FACTS + ", part int, head_id long, head binary, tail binary"))
    ends = made.where("tail is not null")                    # one row per partition that has rows
    everyone = Window.partitionBy(F.lit(0))
    follow = ends.select("part", F.coalesce(F.lead("part").over(everyone.orderBy("part")), F.min("part").over(everyone)).alias("next"))
    heads = ends.select(F.col("part").alias("next"), F.col("head_id"), "head")
    pairs = ends.select("part", "doc_id", "tail").join(follow, "part").join(heads, "next").select("doc_id", "tail", "head_id", "head")
    closed = map_rows(pairs, FACTS, ARROW, lambda: lambda r: _Doc(r[0], r[1], bits).row(_Doc(r[2], r[3], bits), bits))
    return made.where("tail is null").select(*ARROW.names).unionByName(cut_lineage(closed))


def near_counts(prints: DataFrame, radius: int, bits: int = 256, tile: int = 512) -> DataFrame:
    """(fp, n): rows of ``prints`` (fp binary, asks boolean) within ``radius`` bits, for every fingerprint that asks.

    Equal fingerprints are one entry that counts for its rows.  Only entries whose block a query shares are moved;
    crowded blocks are cut into chunks of about ``tile`` entries, each with all queries of the block.
    """
    cuts = [bits // 8 * k // (radius + 1) for k in range(radius + 2)]
    if any(a == b for a, b in zip(cuts, cuts[1:])):
        raise ValueError("a block must hold a byte at least: radius below bits / 8")
    block = lambda fp, k: F.substring(fp, cuts[k] + 1, cuts[k + 1] - cuts[k])
    tables = lambda fp: F.array(*[F.struct(F.lit(k).cast("byte").alias("k"), block(fp, k).alias("key")) for k in range(radius + 1)])
    pool = cut_lineage(prints.groupBy("fp").agg(F.count("*").alias("n"), F.max("asks").alias("asks")))
    entries = pool.select("fp", "n", "asks", F.explode(tables(F.col("fp"))).alias("e")).select("e.k", "e.key", "fp", "n", "asks")
    asked = cut_lineage(entries.where("asks").select("k", "key").distinct())
    met = cut_lineage(entries.join(small_side(asked), ["k", "key"], "left_semi"))
    crowded = cut_lineage(met.groupBy("k", "key").agg(F.ceil(F.count("*") / tile).cast("int").alias("chunks")).where("chunks > 1"))
    rows = (met.join(small_side(crowded), ["k", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
            .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
            .withColumn("chunk", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("mine"))))
            .select("k", "key", "chunk", "fp", F.when(F.col("chunk") == F.col("mine"), F.col("n")).otherwise(0).alias("n"), "asks"))
    by = ["k", "key", "chunk"]
    arrow = pa.schema([("fp", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, _, _), members in groups(batches, len(by)):
            fps = np.frombuffer(b"".join(m[0] for m in members), np.uint8).reshape(len(members), -1)
            n = np.array([m[1] for m in members], np.int64)
            asks = np.flatnonzero([m[2] for m in members])
            words, out = fps.view("<u8"), []
            for at in range(0, len(asks), 64):
                some = asks[at:at + 64]
                near = np.zeros((len(some), len(fps)), np.int64)
                for w in range(words.shape[1]):
                    near += np.bitwise_count(words[some, w][:, None] ^ words[None, :, w])
                near = near <= radius
                for earlier in range(k):                     # that table has counted the pair
                    a, b = cuts[earlier], cuts[earlier + 1]
                    near &= (fps[some, None, a:b] != fps[None, :, a:b]).any(axis=2)
                out += zip((fps[i].tobytes() for i in some), (near @ n).tolist())
            yield table(out, arrow)

    found = rows.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    return found.mapInArrow(run, "fp binary, n long").groupBy("fp").agg(F.sum("n").alias("n"))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256, radius: int = 7,
                          asks: Column | None = None) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near.

    ``edited``: the last floor(n_chars / 3) code points replaced by the first as many (or all) of the next document in
    descending id, the last one's being the first; of equal ids the smaller text hash comes first, null ids last.
    near_*: share of equal bits.  n_near: how many other rows lie within ``radius`` bits, for rows that ask (ids
    divisible by 100, unless ``asks`` says otherwise over doc_id), else null.  Null texts are empty; empty texts have
    no bit set, no character to replace, and are near each other.  Equal texts have equal fingerprints.  A single row
    is its own next.  Repeated rows are rows of their own.  Other columns are ignored, whatever their names.
    """
    asks = F.col("doc_id") % 100 == 0 if asks is None else asks
    facts = edited_prints(docs, id_col, text_col, bits).withColumn("asks", F.coalesce(asks, F.lit(False)))
    near = near_counts(facts.select("fp", "asks"), radius, bits).withColumnRenamed("n", "n_near")
    asking = facts.where("asks").join(near, "fp").withColumn("n_near", F.col("n_near") - 1)
    rest = facts.where("not asks").withColumn("n_near", F.lit(None).cast("long"))
    return asking.unionByName(rest).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"), F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        "near_edited", "near_next", "n_near")
