"""Difference of two versions of a table by key.

Each version is reduced to a digest per bucket of keys: rows and two sums of row hashes, combined map-side, so only
the digests move.  Rows of buckets whose digests agree are never looked at again; rows of the others (at most as many
bucket numbers as there are buckets, broadcast) are compared key by key.  Digests of unequal buckets agree by chance
with a probability of about 2 ** -120.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage


def _hash(columns: list[str], salt: int) -> Column:
    """Hash of a row; nulls count by their place."""
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (qcol(c).isNull(), qcol(c))])


def bucket_digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """(bucket, n, d1, d2)."""
    total = lambda salt: F.sum(_hash(columns, salt).cast("decimal(38,0)"))
    return df.groupBy(F.pmod(_hash(keys, 0), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"), total(1).alias("d1"), total(2).alias("d2"))


def table_diff(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = 4096) -> DataFrame:
    """(keys..., change, columns): keys that were ``added``, ``removed`` or ``changed``, and for those which columns changed.

    The columns compared are those of ``old``; ``new`` must have them, in any order.  Null keys are keys like any
    other, and nulls equal each other.  A key with several rows is compared by all of them: it has changed if a row
    comes more or fewer times; its ``columns`` are those whose values, with their numbers, differ.
    """
    columns = old.columns
    rest = [c for c in columns if c not in keys]
    a, b = old.select(*[qcol(c) for c in columns]), new.select(*[qcol(c) for c in columns])
    da, db = (bucket_digests(x, keys, columns, buckets) for x in (a, b))
    same = da.join(db, ["bucket", "n", "d1", "d2"], "left_semi").select("bucket")
    both = da.select("bucket").union(db.select("bucket")).distinct()
    unequal = cut_lineage(both.join(same, "bucket", "left_anti"))                    # ``buckets`` rows at most
    names = [f"k{i}" for i in range(len(keys))]
    counted = lambda c: F.sum(F.xxhash64(F.lit(c), qcol(c).isNull(), qcol(c)).cast("decimal(38,0)"))

    def side(x: DataFrame, tag: str) -> DataFrame:
        """Per key: rows, a sum of row hashes, and one of hashes per column; hot keys are combined map-side."""
        x = x.withColumn("_bucket", F.pmod(_hash(keys, 0), F.lit(buckets))).join(F.broadcast(unequal), F.col("_bucket") == F.col("bucket"), "left_semi")
        return x.groupBy(*[qcol(k).alias(n) for k, n in zip(keys, names)]).agg(
            F.count("*").alias(f"{tag}n"), F.sum(_hash(columns, 1).cast("decimal(38,0)")).alias(f"{tag}h"),
            F.array(*[counted(c) for c in rest]).cast("array<decimal(38,0)>").alias(f"{tag}c"))

    x, y = side(a, "o"), side(b, "n").withColumnsRenamed({n: f"r{n}" for n in names})
    on = None
    for n in names:
        one = F.col(n).eqNullSafe(F.col(f"r{n}"))
        on = one if on is None else on & one
    got = x.join(y, on, "full_outer")
    change = (F.when(F.col("on").isNull(), "added").when(F.col("nn").isNull(), "removed")
              .when((F.col("on") != F.col("nn")) | (F.col("oh") != F.col("nh")), "changed"))
    differ = F.filter(F.array(*[F.when(F.col("oc")[i] != F.col("nc")[i], F.lit(c)) for i, c in enumerate(rest)]).cast("array<string>"), lambda c: c.isNotNull())
    return (got.withColumn("change", change).where("change is not null")
            .select(*[F.when(F.col("on").isNull(), F.col(f"r{n}")).otherwise(F.col(n)).alias(k) for k, n in zip(keys, names)], "change",
                    F.when(F.col("change") == "changed", differ).alias("columns")))
