"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol

#: Rows of an Arrow batch that are turned into Python objects at a time.
STEP = 256


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has a column that is called so."""
    used, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def utf8(name: str) -> Column:
    """A text column as UTF-8 bytes; null is empty."""
    return F.coalesce(qcol(name).cast("string").cast("binary"), F.lit("").cast("binary"))


def hash_share(name: str, rows: int, of: int, after: int = 0) -> Column:
    """Keeps about ``rows`` of ``of`` rows by the hash of a column, all of them where there are no more.

    ``after``: other rows than those that are kept for so many.
    """
    low, high = (int(min(1.0, x / max(of, 1)) * (1 << 30)) for x in (after, after + rows))
    h = F.pmod(F.xxhash64(F.lit("sample"), qcol(name)), F.lit(1 << 30))
    return (h >= low) & (h < high) if after else h < high


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo m (null for a null id)."""
    return F.crc32(qcol(id_col).cast("string").cast("binary")) % m


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as tuples, converted a few at a time."""
    for at in range(0, batch.num_rows, STEP):
        part = batch.slice(at, STEP)
        yield from zip(*(c.to_pylist() for c in part.columns))


def map_rows(df: DataFrame, schema: str, arrow: pa.Schema, make: Callable[[], Callable[[tuple], tuple | None]]) -> DataFrame:
    """One output row (or none) per input row; ``make`` runs once per task and returns the row function."""

    def run(batches):
        fn = make()
        for batch in batches:
            out = [r for r in map(fn, rows_of(batch)) if r is not None]
            yield table(out, arrow)

    return df.mapInArrow(run, schema)


def table(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)


def groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``n_keys`` values, from batches that are sorted by them."""
    key, rows = None, []
    for batch in batches:
        for r in rows_of(batch):
            if r[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = r[:n_keys], []
            rows.append(r[n_keys:])
    if rows:
        yield key, rows


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path (file, hdfs, s3, gs, abfs) and the path in it."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name no other task or attempt uses; readers only open files that finished tasks reported."""
    ctx = TaskContext.get()
    return f"{prefix}-{ctx.partitionId() if ctx else 0:06d}-{uuid.uuid4().hex[:12]}{suffix}"


def small_side(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A written frame as the small side of a join: broadcast if it is counted to have at most ``rows`` rows, else left to the planner."""
    return F.broadcast(df) if df.count() <= rows else df


_SENT: set[str] = set()


def send_package(spark) -> None:
    """Gives this package to the executors' Python, once per application (as ``--py-files`` would)."""
    import tempfile
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    made = Path(tempfile.mkdtemp()) / f"{root.name}-package.zip"
    with zipfile.ZipFile(made, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(made))
    _SENT.add(app)
