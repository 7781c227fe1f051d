"""Iceberg cube: every grouping of a set of columns, of which only cells with a minimum of rows are kept.

Rows are aggregated once, to the finest cells.  The lattice is then climbed from the coarse groupings to the fine ones:
a cell can only have enough rows if every coarser cell around it has, so each grouping reads the finest cells that all
its parents' surviving cells admit, and a grouping with a parent that kept nothing is never computed.  A grouping keeps at
most rows / minimum cells.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage

#: Surviving cells of a parent that are broadcast at most; more meet in a shuffle.
BROADCAST_CELLS = 100_000


def iceberg_cube(df: DataFrame, columns: list[str], least_rows: int, sums: dict[str, Column] | None = None) -> DataFrame:
    """(columns..., level, n, sums...): cells of all groupings with ``least_rows`` rows or more.

    ``level`` has a bit for each column that is rolled up, the first column's the highest, as SQL's GROUPING; rolled-up
    columns are null, and a null in a column is a value of its own.  ``sums`` are totals of expressions over the rows;
    nulls in them count as nothing.  No rows, no cells.
    """
    names, k = [f"d{i}" for i in range(len(columns))], len(columns)
    totals = {f"s{i}": e for i, e in enumerate((sums or {}).values())}
    add = [F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in totals]]
    finest = cut_lineage(df.groupBy(*[qcol(c).alias(d) for c, d in zip(columns, names)])
                         .agg(F.count("*").alias("n"), *[F.sum(e).alias(s) for s, e in totals.items()]))
    kept: dict[tuple[int, ...], tuple[DataFrame, int]] = {}
    for size in range(k + 1):
        for group in combinations(range(k), size):
            parents = [p for p in combinations(group, size - 1)] if size else []
            if any(not kept[p][1] for p in parents):
                kept[group] = (None, 0)
                continue
            rows = finest
            for p in parents:
                if not p:
                    continue                                 # the grand total admits everything
                cells, n = kept[p]
                small = cells.select(*[F.col(names[i]).alias(f"p{i}") for i in p])
                on = [F.col(names[i]).eqNullSafe(F.col(f"p{i}")) for i in p]
                rows = rows.join(F.broadcast(small) if n <= BROADCAST_CELLS else small, on, "left_semi")
            by = [names[i] for i in group]
            cells = cut_lineage((rows.groupBy(*by) if by else rows.groupBy()).agg(*add).where(F.col("n") >= least_rows))
            kept[group] = (cells, cells.count())
    out = None
    for group, (cells, n) in kept.items():
        if not n:
            continue
        level = sum(1 << k - 1 - i for i in range(k) if i not in group)
        one = cells.select(*[(F.col(d) if i in group else F.lit(None).cast(finest.schema[d].dataType)).alias(columns[i]) for i, d in enumerate(names)],
                           F.lit(level).alias("level"), "n", *[F.col(s).alias(c) for s, c in zip(totals, sums or {})])
        out = one if out is None else out.unionByName(one)
    if out is None:
        empty = finest.limit(0)
        return empty.select(*[F.col(d).alias(c) for d, c in zip(names, columns)], F.lit(0).alias("level"), "n",
                            *[F.col(s).alias(c) for s, c in zip(totals, sums or {})])
    return out
