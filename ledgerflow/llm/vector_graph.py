"""Robust-pruned flat graph over unit vectors, and range-expanding greedy search in it (one shard, numpy)."""

from __future__ import annotations

import numpy as np


def build(x: np.ndarray, degree: int = 16, candidates: int = 48, alpha: float = 1.2, step: int = 512) -> np.ndarray:
    """Out-neighbours (n x degree, -1 where there are fewer) of every unit vector.

    Candidates are the nearest of the shard; robust pruning keeps a candidate unless a kept one is ``alpha``
    times nearer to it than the vector itself is.
    """
    n = len(x)
    out = np.full((n, degree), -1, np.int32)
    k = min(candidates, n - 1)
    if k < 1:
        return out
    for at in range(0, n, step):
        sim = x[at:at + step] @ x.T
        rows = np.arange(len(sim))
        sim[rows, at + rows] = -2
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        dist = 2 - 2 * np.take_along_axis(sim, near, 1)                 # squared distances to the vector
        v = x[near]                                                     # rows x k x dims
        between = 2 - 2 * np.einsum("rkd,rjd->rkj", v, v)
        alive, count = np.ones(near.shape, bool), np.zeros(len(sim), int)
        for c in range(k):                                              # nearest first
            take = alive[:, c] & (count < degree)
            r = rows[take]
            out[at + r, count[r]] = near[r, c]
            count[r] += 1
            alive[r] &= between[r, c] * alpha ** 2 > dist[r]
    return out


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def parts(graph: list[np.ndarray]) -> np.ndarray:
    """Number of the connected part of every vector; ``graph`` holds every edge in both directions."""
    out, n = np.full(len(graph), -1, np.int64), 0
    for i in range(len(graph)):
        if out[i] < 0:
            out[i], new = n, np.array([i])
            while len(new):
                new = np.unique(np.concatenate([graph[j] for j in new]))
                new = new[out[new] < 0]
                out[new] = n
            n += 1
    return out


def search(x: np.ndarray, graph: list[np.ndarray], starts: np.ndarray, q: np.ndarray, least: float, beam: int) -> np.ndarray:
    """Positions whose similarity to ``q`` is ``least`` or more, found by greedy search that expands over the whole range.

    A beam search from the starts finds the neighbourhood; from then on every vector in range is expanded,
    until no new one in range turns up.
    """
    seen = np.zeros(len(x), bool)
    open_, sims = starts, x[starts] @ q
    seen[starts] = True
    done = np.zeros(len(x), bool)
    found, score = open_, sims
    while True:
        best = np.argsort(-score, kind="stable")[:beam]
        go = np.concatenate([found[best], found[score >= least]])
        go = go[~done[go]]
        if not len(go):
            break
        go = np.unique(go)
        done[go] = True
        new = np.concatenate([graph[g] for g in go])
        new = np.unique(new[~seen[new]])
        seen[new] = True
        found, score = np.concatenate([found, new]), np.concatenate([score, x[new] @ q])
        if len(found) > 4 * beam:                                       # keep the beam and the range
            keep = (score >= least) | (score >= np.partition(score, len(score) - beam)[len(score) - beam])
            found, score = found[keep], score[keep]
    return found[score >= least]
