"""Statistics of a growing table from mergeable states: a batch is read when it comes, and not again.

For every batch and column two things are stored: the state (count, mean, squared deviations, least, greatest, and rows
per bin) and the values themselves, sorted by bin.  The bins are fixed for all batches: ``PARTS`` equal parts of every
power of two, by a function that never falls.  Statistics of the whole merge the states; a quantile's rank lies in one
bin, and one scan of that bin's values over all batches, which Parquet's statistics let it find, gives its exact value.
A batch that is written again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null, qcol
from ..functions.prefix import prefix_by_key
from ..session import cut_lineage

PARTS = 16


def bin_of(x: Column) -> Column:
    """A whole number that never falls as x rises; a power of two's part is found alike from both of its sides."""
    a = F.abs(x)
    e = F.floor(F.log2(a))
    part = F.floor((e + a / F.pow(F.lit(2.0), e) - 1) * PARTS).cast("long") + 1100 * PARTS          # above 0 for all doubles
    return F.when(x == 0, F.lit(0).cast("long")).when(a == F.lit(float("inf")), F.lit(1 << 40)).otherwise(part) * F.signum(x).cast("long")


def append_batch(df: DataFrame, columns: list[str], folder: str, batch: str) -> None:
    """Stores the states and values of one batch below ``folder``; of ``df`` a sample is read for the order of the values, then all."""
    cells = [F.struct(F.lit(c).alias("column"), nan_to_null(qcol(c).cast("double")).alias("x")) for c in columns]
    long = df.select(F.inline(F.array(*cells))).where("x is not null").withColumn("bin", bin_of(F.col("x")))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = f"{folder}/values/batch={batch}"
    (long.repartitionByRange(n, "column", "bin", "x").sortWithinPartitions("column", "bin", "x").write.mode("overwrite").parquet(values))
    stored = df.sparkSession.read.schema(long.schema).parquet(values)
    moments = stored.groupBy("column").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("*")).alias("m2"),
                                           F.min("x").alias("min"), F.max("x").alias("max"))
    bins = stored.groupBy("column", "bin").agg(F.count("*").alias("n"))
    moments.coalesce(1).write.mode("overwrite").parquet(f"{folder}/moments/batch={batch}")           # one row per column
    bins.coalesce(1).write.mode("overwrite").parquet(f"{folder}/bins/batch={batch}")                 # one row per column and bin


def merged_stats(spark: SparkSession, columns: list[str], folder: str, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """P1 over all batches: column, count, mean, std, min, q25, q50, q75 (or q<percent>), max; ``columns`` without a value have count 0.

    Reads the states, and of the values only the bins that hold a wanted rank.
    """
    names = spark.createDataFrame([(c,) for c in columns], "column string")
    m = spark.read.parquet(f"{folder}/moments").where(F.col("column").isin(columns))
    whole = m.groupBy("column").agg(F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"), F.min("min").alias("min"),
                                    F.max("max").alias("max"))
    spread = m.join(F.broadcast(whole.select("column", F.col("mean").alias("all"))), "column").groupBy("column").agg(      # ``columns`` rows
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("all")) * (F.col("mean") - F.col("all"))).alias("m2"))
    bins = spark.read.parquet(f"{folder}/bins").where(F.col("column").isin(columns)).groupBy("column", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("column").orderBy("bin")                                                   # the bins of a column: 70,000 at most
    bins = bins.withColumn("upto", F.sum("n").over(w) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy("column")))
    pos = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)]))
    ranks = bins.select("column", "bin", "n", "upto", "all", pos.alias("q")).withColumn("pos", F.col("q.p") * (F.col("all") - 1))
    ranks = ranks.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))))
    ranks = cut_lineage(ranks.where((F.col("rank") >= F.col("upto")) & (F.col("rank") < F.col("upto") + F.col("n")))
                        .select("column", "bin", "upto", F.col("q.i").alias("i"), "pos", "rank"))        # two rows per column and quantile
    want = ranks.select("column", "bin").distinct().collect()
    values = spark.read.schema("column string, x double, bin long").parquet(f"{folder}/values")
    here = F.lit(False)
    for r in want:                                                                                    # literals: pushed down to the files
        here = here | ((F.col("column") == r["column"]) & (F.col("bin") == r["bin"]))
    same = values.where(here).groupBy("column", "bin", "x").agg(F.count("*").alias("n"))
    same = same.withColumn("key", F.struct("column", "bin").cast("string"))
    found = prefix_by_key(same, "key", ["x"], "n").select("column", "bin", "x", "n", F.col("_prev_sum").cast("long").alias("before"))
    at = F.col("rank") - F.col("upto")
    hit = found.join(F.broadcast(ranks), ["column", "bin"]).where((at >= F.col("before")) & (at < F.col("before") + F.col("n")))
    ends = hit.groupBy("column", "i", "pos").agg(F.min_by("x", "rank").alias("lo"), F.max_by("x", "rank").alias("hi"))
    part = F.col("pos") - F.floor("pos")
    value = F.when(part == 0, F.col("lo")).otherwise((F.ceil("pos") - F.col("pos")) * F.col("lo") + part * F.col("hi"))
    q = ends.groupBy("column").agg(*[F.max(F.when(F.col("i") == i, value)).alias(f"q{100 * p:g}") for i, p in enumerate(probs)])
    out = names.join(whole, "column", "left").join(spread, "column", "left").join(q, "column", "left")
    std = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    return out.select("column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "mean", std.alias("std"), "min",
                      *[f"q{100 * p:g}" for p in probs], "max")
