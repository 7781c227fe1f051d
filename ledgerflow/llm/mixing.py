"""Mixing sources to target weights, with DataFrame functions only.

1. Targets: sources share the mix by weight; none gets more than ``max_repeat`` times its own size, and what
   that frees is shared again by weight.
2. Packing: the words of a source, documents in id order, form one stream that is cut into blocks of
   ``block`` words.
3. Drawing: the mix has target / block slots per source, and as many in all.  Every slot of every output
   shard draws its source at random, which makes a shard's source counts multinomial.  The slots a source
   draws beyond its number are handed to the sources that drew too few, in shard order, so that totals are
   exact.
4. Every source maps the running number of its slots to a block: numbers 0..M-1 visit the M blocks in a
   pseudorandom permutation, M..2M-1 in another one.  The permutation is computed from the number alone, so
   no source is ever sorted.
5. Documents join the drawn blocks by (source, block index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..functions.prefix import prefix_by_key
from ..session import cut_lineage
from .common import fresh

WORD = r"[^\x20\x09-\x0D]+"
#: Key of the null source; other keys begin with "=".
NULL_KEY = ""
#: What draws and permutations are made with.
SEED = 20250607


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """(src, key, source_size, target) from (key, source_size); src numbers the sources by code point, null last.

    Water filling: in ascending order of cap / weight, a source is at its cap when what is left for it and
    those behind it, shared by weight, gives it that much.  The first one below its cap sets the level of all
    behind it.
    """
    everyone = Window.partitionBy(F.lit(0))             # one row per source
    by_name = everyone.orderBy((F.col("key") == NULL_KEY).asc(), F.col("key").cast("binary").asc())
    s = sizes.withColumn("src", (F.row_number().over(by_name) - 1).cast("int"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    s = s.withColumns({"_w": w, "_cap": F.col("source_size") * F.lit(float(max_repeat))})
    order = everyone.orderBy(F.col("_cap") / F.col("_w"), "src")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    s = s.withColumn("_level", left / F.sum("_w").over(onward))       # per unit of weight
    s = s.withColumn("_full", F.col("_level") * F.col("_w") >= F.col("_cap"))
    s = s.withColumn("_open", F.max(F.when(~F.col("_full"), F.col("_level"))).over(everyone))
    return s.select("src", "key", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_open") * F.col("_w")).alias("target"))


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(NULL_KEY))


def row_hash(docs: DataFrame) -> Column:
    """Hash of a row's columns (maps aside); rows that agree in all of them are interchangeable."""
    return F.xxhash64(*[qcol(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])


def placed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, h, key, size, first): ``first`` is the document's first word in its source's stream; h hashes the row."""
    rows = cut_lineage(docs.select(qcol(id_col).cast("long").alias("doc_id"), row_hash(docs).alias("h"),     # texts are read once
                                   source_key(qcol(source_col)).alias("key"), word_count(qcol(text_col).cast("string")).alias("size")))
    placed = prefix_by_key(rows, "key", ["doc_id", "h", "size"], "size")
    return placed.select("doc_id", "h", "key", "size", F.col("_prev_sum").cast("long").alias("first"))


def permuted(x: Column, m: Column, *key: Column, rounds: int = 16) -> Column:
    """Image of x in 0..m-1 under a pseudorandom permutation given by ``key`` (swap-or-not rounds)."""

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), m) - x, m)
        return F.when(F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), step)


def drawn_blocks(targets: DataFrame, block: int, shard_slots: int = 4096, max_repeat: int = 2, seed: int = SEED) -> DataFrame:
    """The mix: (shard, slot, src, key, block), one row per slot, from (src, key, source_size, target)."""
    spark = targets.sparkSession
    t = (targets.withColumn("m", F.ceil(F.col("source_size") / block)).where("m > 0")
         .withColumn("q", F.least(F.round(F.col("target") * F.col("m") / F.col("source_size")).cast("long"), F.col("m") * max_repeat))
         .select("src", "key", "m", "q"))
    upto = Window.partitionBy(F.lit(0)).orderBy("src")
    t = cut_lineage(t.withColumn("hi", F.sum("q").over(upto)))
    whole = int(t.agg(F.coalesce(F.max("hi"), F.lit(0))).first()[0])
    ends = t.agg(F.array_sort(F.collect_list(F.struct("hi", "src"))).alias("e"))           # one entry per source

    def source_at(ends: DataFrame, u: Column) -> Column:
        return F.element_at(F.filter(F.col("e"), lambda x: x["hi"] > u), 1)

    # a uniform draw among all slots picks a source with probability q / whole
    u = F.pmod(F.xxhash64(F.lit(seed), "slot"), F.lit(max(whole, 1)))
    slots = (spark.range(whole).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard_slots).alias("shard"))
             .withColumn("e", ends.scalar()).select("slot", "shard", source_at(ends, u)["src"].alias("src")))
    # a slot's number in its source: the source's slots in earlier shards and earlier in this one
    counts = slots.groupBy("src", "shard").agg(F.count("*").alias("k"))
    counts = prefix_by_key(counts, "src", ["shard"], "k").select("src", "shard", F.col("_prev_sum").cast("long").alias("base"))
    inside = Window.partitionBy("shard", "src").orderBy("slot")
    numbered = (slots.withColumn("r", F.row_number().over(inside) - 1).join(counts, ["shard", "src"])
                .join(t.select("src", "q"), "src").select("shard", "slot", "src", "q", (F.col("base") + F.col("r")).alias("j")))
    numbered = cut_lineage(numbered)
    # slots beyond a source's number go to the sources that drew too few; of order sqrt(slots) rows, so one task numbers them
    kept = numbered.groupBy("src").agg(F.count(F.when(F.col("j") < F.col("q"), 1)).alias("kept"))
    short = t.join(kept, "src", "left").select("src", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("q") - F.coalesce("kept", F.lit(0))).alias("d"))
    short = cut_lineage(short.where("d > 0").withColumn("hi", F.sum("d").over(upto)))
    gaps = short.agg(F.array_sort(F.collect_list(F.struct("hi", "src", "d", "kept"))).alias("e"))
    spare = numbered.where("j >= q").withColumn("u", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("slot")) - 1)
    spare = spare.withColumn("e", gaps.scalar()).withColumn("g", source_at(gaps, F.col("u")))
    moved = spare.select("shard", "slot", F.col("g.src").alias("src"), (F.col("g.kept") + F.col("u") - (F.col("g.hi") - F.col("g.d"))).alias("j"))
    final = numbered.where("j < q").select("shard", "slot", "src", "j").unionByName(moved).join(t.select("src", "key", "m"), "src")
    turn = F.xxhash64(F.lit(seed), "key", F.floor(F.col("j") / F.col("m")))
    final = final.select("shard", "slot", "src", "key", "m", F.pmod("j", "m").alias("x"), turn.alias("turn"))
    return final.select("shard", "slot", "src", "key", permuted(F.col("x"), F.col("m"), F.col("turn")).alias("block"))


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """One row per document and block that it has words in: (doc_id, h, key, size, first, block, words)."""
    last = F.col("first") + F.col("size")
    rows = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((last - 1) / block))))
    return rows.withColumn("words", F.least(last, (F.col("block") + 1) * block) - F.greatest(F.col("first"), F.col("block") * block))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, block: int = 64) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the row in the mix, repeats counted) per row of ``docs``.

    Null texts have no words; a null source is a source of its own, the last; null ids come first in their
    source's stream.  Repeated rows hold words of their own.  An empty table gives no rows.  Other columns are
    ignored, whatever their names.  Runs over the same rows agree.
    """
    placed, targets = _plan(docs, id_col, text_col, source_col, weights, share, max_repeat)
    uses = drawn_blocks(targets, block, max_repeat=max_repeat).groupBy("key", "block").agg(F.count("*").alias("uses"))
    taken = (_pieces(placed, block).join(uses, ["key", "block"], "left").groupBy("key", "first", "doc_id", "size")
             .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken")))
    none = placed.where("size = 0").select("key", "first", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(none).join(targets, "key").select(
        "doc_id", F.when(F.col("key") != NULL_KEY, F.expr("substr(key, 2)")).alias("source"), "size", "source_size", "target", "taken")


def _plan(docs, id_col, text_col, source_col, weights, share, max_repeat) -> tuple[DataFrame, DataFrame]:
    placed = cut_lineage(placed_documents(docs, id_col, text_col, source_col))
    sizes = placed.groupBy("key").agg(F.sum("size").alias("source_size"))
    return placed, cut_lineage(source_targets(sizes, weights, share, float(max_repeat)))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: int = 2, block: int = 64) -> DataFrame:
    """The mix as documents with the columns of ``docs``.

    A row comes once for each time round that the mix takes words of it, up to ``max_repeat`` times, with the
    words of the blocks taken then; where these are all its words the text is unchanged, else they are joined
    by spaces.  ``n_chars``, if there, is the new text's length.  Rows without words are not in the mix.
    """
    placed, targets = _plan(docs, id_col, text_col, source_col, weights, share, max_repeat)
    uses = drawn_blocks(targets, block, max_repeat=max_repeat).groupBy("key", "block").agg(F.count("*").alias("uses"))
    parts = (_pieces(placed, block).join(uses, ["key", "block"]).groupBy("key", "first", "doc_id", "h", "size")
             .agg(F.array_sort(F.collect_list(F.struct((F.greatest("first", F.col("block") * block) - F.col("first") + 1).alias("from"), "words", "uses"))).alias("p")))
    times = (parts.withColumn("round", F.explode(F.sequence(F.lit(1), F.array_max(F.transform("p", lambda x: x["uses"])).cast("int"))))
             .withColumn("p", F.filter("p", lambda x: x["uses"] >= F.col("round")))
             .withColumn("all", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["words"]) == F.col("size")))
    i, h, pi, ph, takes, take = fresh(docs, "_doc", "_hash", "_plan_doc", "_plan_hash", "_takes", "_take")
    plan = (times.groupBy("doc_id", "h").agg(F.collect_list(F.struct("all", F.when(~F.col("all"), F.col("p")).alias("p"))).alias(takes))
            .withColumnsRenamed({"doc_id": pi, "h": ph}))
    rows = docs.withColumns({i: qcol(id_col).cast("long"), h: row_hash(docs)}).dropDuplicates([i, h])
    out = rows.join(plan, (F.col(h) == F.col(ph)) & F.col(i).eqNullSafe(F.col(pi))).withColumn(take, F.explode(takes))
    words = F.regexp_extract_all(qcol(text_col), F.lit(f"({WORD})"), F.lit(1))
    cut = lambda w: F.flatten(F.transform(F.col(take)["p"], lambda x: F.slice(w, x["from"].cast("int"), x["words"].cast("int"))))
    some = F.array_join(F.transform(F.array(words), cut)[0], " ")        # bound by a lambda: the text is cut into words once
    out = out.withColumn(text_col, F.when(F.col(take)["all"], qcol(text_col)).otherwise(some))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(qcol(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[qcol(c) for c in docs.columns])
