"""Greedy string tiling of two token sequences by running Karp-Rabin."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
#: Pairs of equal windows that are held at a time.
PAIRS = 2_000_000


def windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of all runs of ``size`` tokens (uint64 token values, arithmetic modulo 2**64)."""
    if len(tokens) < size:
        return np.zeros(0, U64)
    h = np.zeros(len(tokens) - size + 1, U64)
    for k in range(size):
        h = h * BASE + tokens[k:len(tokens) - size + 1 + k]
    return h


def _rolled(tokens: np.ndarray, size: int) -> np.ndarray:
    """As ``windows``, by doubling: any run length in O(log size) passes."""
    if len(tokens) < size:
        return np.zeros(0, U64)
    power, width, block = BASE, 1, tokens
    out, done = None, 0
    while size:
        if size & 1:
            if out is None:
                out, done = block, width
            else:
                n = min(len(out), len(block) - done)
                out, done = out[:n] * power + block[done:done + n], done + width
        size >>= 1
        if size:
            block = block[:len(block) - width] * power + block[width:]
            with np.errstate(over="ignore"):
                width, power = 2 * width, power * power
    return out


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` tokens that hold no marked one."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[size:] == sums[:-size]) if len(marked) >= size else np.zeros(0, np.int64)


def _runs(a, b, marked_a, marked_b, size) -> np.ndarray:
    """Maximal runs (start in a, start in b, length) of at least ``size`` equal unmarked tokens.

    Equal windows are paired ``PAIRS`` at a time, at least all of one start in a; runs on one diagonal that the
    pieces cut apart are joined.
    """
    none = np.zeros((0, 3), np.int64)
    i, j = _free(marked_a, size), _free(marked_b, size)
    if not len(i) or not len(j):
        return none
    ha, hb = _rolled(a, size)[i], _rolled(b, size)[j]
    by = np.argsort(hb, kind="stable")
    lo, hi = np.searchsorted(hb[by], ha, "left"), np.searchsorted(hb[by], ha, "right")
    some = np.flatnonzero(hi > lo)
    if not len(some):
        return none
    i, lo, n = i[some], lo[some], (hi - lo)[some]
    upto, made, at = np.cumsum(n), [], 0
    while at < len(i):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        k = n[at:stop]
        x = np.repeat(i[at:stop], k)
        y = j[by[np.repeat(lo[at:stop] - (np.cumsum(k) - k), k) + np.arange(len(x))]]
        order = np.lexsort((x, x - y))                     # along diagonals
        x, y = x[order], y[order]
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(x - y) != 0) | (np.diff(x) != 1)]))
        made.append(np.stack([x[starts], y[starts], np.diff(np.append(starts, len(x)))], axis=1))
        at = stop
    r = np.concatenate(made)
    if len(made) > 1:
        r = r[np.lexsort((r[:, 0], r[:, 0] - r[:, 1]))]
        first = np.concatenate([[True], (np.diff(r[:, 0] - r[:, 1]) != 0) | (r[1:, 0] != r[:-1, 0] + r[:-1, 2])])
        r = np.column_stack([r[first, :2], np.add.reduceat(r[:, 2], np.flatnonzero(first))])
    r[:, 2] += size - 1
    return r


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in a, start in b, length >= ``least``): longest common runs first, none overlapping.

    The search length starts at the shorter sequence and halves down to ``least``; at each length the
    longest matches are marked until none is left, so that no shorter match is marked before a longer one.
    """
    marked_a, marked_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    out, size = [], max(least, min(len(a), len(b)))
    while True:
        while len(found := _runs(a, b, marked_a, marked_b, size)):
            found = found[found[:, 2] == found[:, 2].max()]
            for i, j, n in found[np.lexsort((found[:, 1], found[:, 0]))].tolist():
                if marked_a[i:i + n].any() or marked_b[j:j + n].any():
                    continue
                if not np.array_equal(a[i:i + n], b[j:j + n]):     # a hash collision; never marked, so left out by hand
                    marked_b[j] = True
                    continue
                marked_a[i:i + n] = marked_b[j:j + n] = True
                out.append((i, j, n))
        if size == least:
            return out
        size = max(least, size // 2)
