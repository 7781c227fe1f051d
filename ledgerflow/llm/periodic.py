"""Periodic runs of words, found with a recompression grammar instead of suffix arrays.

1. The words of a batch of documents are numbered and strung together, a symbol of its own before, between and
   behind the documents; ``recompression.Grammar`` compresses them.
2. Candidates lie on a harmonic grid: for every period q the positions i at multiples of (least - 1) * q, paired
   with i + q.  A run of period q and at least ``least`` * q words has such an i with i + q in it, so none is
   missed, and all periods together give about n / 3 * ln n candidates.  Those whose two words differ go at once.
3. Grammar queries extend a pair to both sides; that gives the whole stretch that keeps period q.
4. A stretch found with several periods is a run of the smallest (the others are its multiples).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.exprs import qcol
from .common import rows_of, table, utf8
from .recompression import Grammar

#: Words that are compressed together at least; a longer document is a batch of its own.
BATCH_WORDS = 100_000
#: Pairs that are extended at a time.
PAIRS = 1_000_000


def find_runs(texts: list[np.ndarray], least: int = 4, least_words: int = 6) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text of integers >= 0, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(np.append(1, sizes + 1))              # of every text, one mark before each
    marks = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    line = np.empty(int(starts[-1]), np.int64)
    line[starts - 1] = marks + np.arange(len(starts))
    for t, at in zip(texts, starts):
        line[at:at + len(t)] = t
    grammar, top = None, int(sizes.max(initial=0)) // least
    found, held, n_held = [], [], 0
    for q in range(1, top + 1):
        step = (least - 1) * q
        same = np.flatnonzero(line[:len(line) - q:step] == line[q::step])
        if len(same):
            held.append((same * step, np.full(len(same), q)))
            n_held += len(same)
        if held and (n_held > PAIRS or q == top):
            grammar = grammar or Grammar(line)
            i, p = (np.concatenate(x) for x in zip(*held))
            held, n_held = [], 0
            right, left = grammar.extend(i, i + p), grammar.extend(i, i + p, -1)
            length = right + left - 1 + p
            ok = length >= np.maximum(least_words, least * p)
            found.append(np.stack([i - left + 1, length, p], axis=1)[ok])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    if len(runs):
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        runs = runs[np.concatenate([[True], (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)])]   # smallest period of a stretch
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        which = np.searchsorted(starts, runs[:, 0], side="right") - 1
        for d, (s, n, p) in zip(which.tolist(), runs.tolist()):
            out[d].append((s - int(starts[d]), n, p))
    return out


def repeated_tail(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each of n places: every tenth id, by its crc32, repeats a stretch to the end."""
    at = np.arange(n)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + np.arange(n - a) % p
    return at


def _summary(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    kept, best = np.ones(len(words), bool), None
    for s, n, p in runs:
        kept[s + p:s + n] = False
        if best is None or n * best[2] > best[1] * p:        # ties stay with the smaller start, then period
            best = (s, n, p)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    rest = b" ".join([words[k] for k in np.flatnonzero(kept)] if runs else words)
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 4, least_words: int = 6,
                  repeat_tails: bool = False) -> DataFrame:
    """Per row: doc_id, n_runs, the run of greatest length / period (start, length, period, exponent_milli), and the
    sha256 of all runs (runs_sha256) and of the text without its repeats (collapsed_sha256).

    A run is a longest stretch of words with smallest period q, of at least ``least`` * q and ``least_words`` words.
    ``repeat_tails`` first writes the end of every tenth document as a repeated stretch, chosen by its id.
    Null and wordless texts have no run: the four columns are null, the digests those of the empty text.  A null id
    leaves the text as it is.  Repeated rows come repeatedly.  Ties go to the smallest start, then period.  A text of
    any length is one task's work; batches hold ``BATCH_WORDS`` words or one text.  Other columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    arrow = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                       ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def flush(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        texts = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for _, words in held]
        return table([_summary(d, words, runs) for (d, words), runs in zip(held, find_runs(texts, least, least_words))], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, text in rows_of(batch):
                words = text.split()                         # bytes: white space of ASCII only
                if repeat_tails:
                    words = [words[k] for k in repeated_tail(len(words), doc_id)]
                held.append((doc_id, words))
                size += len(words)
                if size >= BATCH_WORDS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    src = docs.select(qcol(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
                               "runs_sha256 string, collapsed_sha256 string")
