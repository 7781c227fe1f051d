"""Prediction by partial matching: the trie of byte contexts as sorted arrays, and its code lengths.

A symbol is a byte; 0xFF, which UTF-8 never uses, stands before the text (so that contexts at its start
are ordinary contexts) and once after it as its end.  The trie of order D is the table of (D+1)-grams with
counts.  Shorter contexts count by update exclusion: a symbol's count is the number of distinct longer
contexts that it followed.

Coding starts at the longest context that was seen.  There, and after every escape in the next shorter
context, symbols of the longer context are excluded; with total count n and t distinct symbols left, a symbol
has probability (count - d) / n and the escape d t / n (method D's rule with discount d).  Below order 0 the symbols that
training never saw share the rest evenly.  Counts nest, so the symbols to exclude at a context are exactly
those of its child: what exclusion takes away is one number per context, known before coding.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
END = b"\xff"
#: What every symbol's count gives up to the escape.
DISCOUNT = 0.3


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All (order+1)-grams of the texts, end symbols included, and the number of grams of each text."""
    pad = END * order
    buf = np.frombuffer(b"".join([p for t in texts for p in (pad, t.replace(END, b"\xfe"), END)]), np.uint8)
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    code = np.zeros(max(len(buf) - order, 0), U64)
    for k in range(order + 1):
        code = code << U64(8) | buf[k:len(buf) - order + k]
    if order and len(texts) > 1:                       # windows that run from one text into the next
        keep = np.ones(len(code), bool)
        ends = np.cumsum(lens + order)[:-1]
        keep[(ends[:, None] - order + np.arange(order)).ravel()] = False
        code = code[keep]
    return code, lens


def count_grams(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.sort(code)
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.diff(np.append(first, len(code)))


def _sums(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(code, kind="stable")
    code, n = code[at], n[at]
    if not len(code):
        return code, n
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(n, first)


def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each x in the sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return at, table[at] == x


class Trie:
    """Static PPM model from the (order+1)-grams ``code`` (in any sequence) and their counts ``n``.

    ``low``: the pairs (previous byte, byte) of the whole model, when ``code`` holds only the grams of some
    two-byte contexts; it then scores only grams of these contexts.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray] | None = None):
        if low is not None and order < 2:
            raise ValueError("only a model of order 2 or more can be cut")
        self.order = order
        self.code: list[np.ndarray] = [None] * (order + 1)
        self.n: list[np.ndarray] = [None] * (order + 1)
        self.ctx, self.total, self.kinds, self.gone = ([None] * (order + 1) for _ in range(4))
        code, n = _sums(code.astype(U64), n.astype(np.int64))
        for k in range(order, -1, -1):
            if k < order:
                code, n = _sums(code & U64((1 << 8 * (k + 1)) - 1), np.ones_like(n))
            if k == 1 and low is not None:
                code, n = _sums(low[0].astype(U64), low[1].astype(np.int64))
            self.code[k], self.n[k] = code, n
            self.ctx[k], first = np.unique(code >> U64(8), return_index=True)
            self.total[k] = np.add.reduceat(n, first) if len(n) else n
            self.kinds[k] = np.diff(np.append(first, len(code)))
        for k in range(1, order + 1):                  # counts, in the parent, of the symbols each context knows
            at, _ = _find(self.code[k - 1], self.code[k] & U64((1 << 8 * k) - 1))
            first = np.searchsorted(self.code[k] >> U64(8), self.ctx[k])
            self.gone[k] = np.add.reduceat(self.n[k - 1][at], first) if len(at) else at

        self._index()

    def _index(self) -> None:
        """Open-addressed table of the full-length grams with their log10 probabilities."""
        code, k = self.code[self.order], self.order
        size = max(8, int(1.6 * len(code)).bit_length())
        self.shift = U64(64 - size)
        self.key, self.val = np.full((1 << size) + 64, ~U64(0)), np.zeros((1 << size) + 64, np.float32)
        at, _ = _find(self.ctx[k], code >> U64(8))
        logs = np.log10((self.n[k] - DISCOUNT) / self.total[k][at]) if len(code) else np.zeros(0)
        slot, rest, self.probes = self._slot(code), np.arange(len(code)), 0
        while len(rest) and self.probes < 64:
            spot = slot[rest] + self.probes
            free = np.flatnonzero(self.key[spot] == ~U64(0))
            _, one = np.unique(spot[free], return_index=True)
            won = free[one]
            self.key[spot[won]], self.val[spot[won]] = code[rest[won]], logs[rest[won]]
            rest = np.delete(rest, won)
            self.probes += 1                           # what is left after 64 steps is found by the slow way

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def logs(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each gram after the others."""
        slot = self._slot(code)
        got = self.key[slot] == code
        out = np.where(got, self.val[slot], np.float32(0)).astype(float)
        rest = np.flatnonzero(~got)
        slow = [rest[:0]]
        for p in range(1, self.probes):
            if not len(rest):
                break
            spot = slot[rest] + p
            key = self.key[spot]
            hit, gone = key == code[rest], key == ~U64(0)
            out[rest[hit]] = self.val[spot[hit]]
            slow.append(rest[gone])
            rest = rest[~(hit | gone)]
        slow = np.concatenate([*slow, rest])
        out[slow] = self._walk(code[slow])
        return out

    def _walk(self, code: np.ndarray) -> np.ndarray:
        """The same by walking down from the longest context."""
        out = np.zeros(len(code))
        todo = np.arange(len(code))
        child = np.full(len(code), -1)                 # the context one longer, where it was seen
        for k in range(self.order, -1, -1):
            if not len(todo):
                return out
            g = code[todo] & U64((1 << 8 * (k + 1)) - 1)
            node, known = _find(self.ctx[k], g >> U64(8))
            entry, hit = _find(self.code[k], g)
            below = child[todo]
            had = below >= 0
            n, t = np.zeros(len(todo)), np.zeros(len(todo))
            if len(self.ctx[k]):
                n, t = self.total[k][node].astype(float), self.kinds[k][node].astype(float)
            if had.any():
                n[had] -= self.gone[k + 1][below[had]]
                t[had] -= self.kinds[k + 1][below[had]]
            hit &= known
            esc = known & ~hit & (t > 0)
            if hit.any():
                out[todo[hit]] += np.log10((self.n[k][entry[hit]] - DISCOUNT) / n[hit])
            out[todo[esc]] += np.log10(DISCOUNT * t[esc] / n[esc])
            child[todo] = np.where(known, node, below if k == self.order else -1)
            todo = todo[~hit]
        out[todo] -= np.log10(256 - len(self.code[0]))
        return out


def pieces(texts: list[bytes], order: int, limit: int = 1 << 19):
    """Grams of the texts in arrays of bounded length, each with (text number, its grams) in sequence."""
    some: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) > limit:                             # a long text goes by overlapping windows
            whole = END * order + t.replace(END, b"\xfe") + END
            for at in range(0, len(t) + 1, limit):
                buf = np.frombuffer(whole[at:at + limit + order], np.uint8)
                code = np.zeros(len(buf) - order, U64)
                for k in range(order + 1):
                    code = code << U64(8) | buf[k:len(buf) - order + k]
                yield code, [(i, len(code))]
            continue
        some.append(i)
        size += len(t)
        if size >= limit:
            code, lens = grams([texts[j] for j in some], order)
            yield code, list(zip(some, lens.tolist()))
            some, size = [], 0
    if some:
        code, lens = grams([texts[j] for j in some], order)
        yield code, list(zip(some, lens.tolist()))
