"""Run-length grammars by recompression, and extension queries on them.

Levels alternate between two rules.  Block compression replaces every maximal stretch of one symbol by a symbol
of its own for (symbol, length).  Pair compression splits the symbols into a left and a right half and replaces
every left symbol that a right one follows, together with it, by a symbol for the pair.  Both look at nothing but
neighbouring symbols, so equal stretches of the text are cut alike except at their ends.

A query walks two positions up the levels side by side: where a symbol is not the first of its parent, it is
compared at its own level first (one symbol, or the rest of a block), then both go on at parents.  Once the
symbols differ, it walks down to the first children that differ.  Each level costs a step, whatever the length
of the extension.  Queries are NumPy arrays: all of them climb a level at a time.
"""

from __future__ import annotations

import numpy as np

ODD1, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _sides(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A bit per symbol that says which half it is in."""
    h = (symbols.astype(np.uint64) + np.uint64(seed << 32)) * ODD1
    h ^= h >> np.uint64(29)
    return (h * ODD2 >> np.uint64(63)).astype(bool)


class Grammar:
    """Grammar of a text of integers >= 0 whose first and last symbols occur nowhere else in it."""

    def __init__(self, text: np.ndarray):
        self.symbols = [np.asarray(text, np.int64)]         # level 0 is the text
        self.parent: list[np.ndarray] = []                  # level k: position in level k + 1
        self.first: list[np.ndarray] = []                   # level k + 1: position of the first child in level k
        self.is_block: list[bool] = []
        names, seed = int(self.symbols[0].max(initial=-1)) + 1, 0
        while len(s := self.symbols[-1]) > 1 and np.bincount(s).max() > 1:
            head = np.concatenate([[True], s[1:] != s[:-1]])
            if not head.all():
                first = np.flatnonzero(head)
                size = np.diff(first, append=len(s))
                made = s[first]
                many = np.flatnonzero(size > 1)
                names = self._name(made, many, size[many], int(size.max()) + 1, names)
                self._add(made, head, first, True)
                continue
            left = _sides(s, seed)
            seed += 1
            pair = left[:-1] & ~left[1:]
            if (other := ~left[:-1] & left[1:]).sum() > pair.sum():
                pair = other
            if not pair.any():
                continue
            head = np.concatenate([[True], ~pair])
            first = np.flatnonzero(head)
            made = s[first]
            many = np.flatnonzero(np.diff(first, append=len(s)) > 1)
            names = self._name(made, many, s[first[many] + 1], names, names)
            self._add(made, head, first, False)

    @staticmethod
    def _name(made: np.ndarray, at: np.ndarray, second: np.ndarray, base: int, names: int) -> int:
        """Equal (symbol, second) get equal new names, from ``names`` on."""
        kinds, which = np.unique(made[at] * base + second, return_inverse=True)
        made[at] = names + which
        return names + len(kinds)

    def _add(self, made: np.ndarray, head: np.ndarray, first: np.ndarray, is_block: bool) -> None:
        self.parent.append(np.cumsum(head) - 1)
        self.first.append(np.append(first, len(head)))
        self.is_block.append(is_block)
        self.symbols.append(made)

    def extend(self, i: np.ndarray, j: np.ndarray, way: int = 1) -> np.ndarray:
        """How many symbols from positions i and j on (i < j, both included) agree, to the right (way 1) or left (-1)."""
        edge = (lambda f, p: f[p]) if way > 0 else (lambda f, p: f[p + 1] - 1)
        back = (lambda f, p: f[p + 1] - 1) if way > 0 else (lambda f, p: f[p])
        q, x, y = np.arange(len(i)), np.array(i, np.int64), np.array(j, np.int64)
        differ = []                                          # per level: queries whose symbols differ there
        for level, s in enumerate(self.symbols):
            apart = s[x] != s[y]
            found = [(q[apart], x[apart], y[apart])]
            q, x, y = q[~apart], x[~apart], y[~apart]
            if level < len(self.parent) and len(q):
                up, f = self.parent[level], self.first[level]
                px, py = up[x], up[y]
                inside = (edge(f, px) != x) | (edge(f, py) != y)
                if self.is_block[level]:
                    rx, ry = np.abs(back(f, px) - x) + 1, np.abs(back(f, py) - y) + 1
                    step, apart = np.minimum(rx, ry) * inside, inside & (rx != ry)
                else:
                    step, apart = inside.astype(np.int64), np.zeros(len(q), bool)
                x, y = x + way * step, y + way * step
                found.append((q[apart], x[apart], y[apart]))
                q, x, y = q[~apart], up[x[~apart]], up[y[~apart]]
            differ.append(tuple(map(np.concatenate, zip(*found))))
        q, x, y = differ.pop()
        for level in range(len(differ) - 1, -1, -1):
            s, f = self.symbols[level], self.first[level]
            cx, cy = edge(f, x), edge(f, y)
            step = np.minimum(f[x + 1] - f[x], f[y + 1] - f[y]) if self.is_block[level] else 1
            same = (s[cx] == s[cy]) * step
            q, x, y = (np.concatenate(p) for p in zip((q, cx + way * same, cy + way * same), differ[level]))
        out = np.empty(len(i), np.int64)
        out[q] = np.abs(x - np.asarray(i)[q])
        return out
