"""Brute-force references in numpy for the point operators (tests only)."""

from __future__ import annotations

import itertools

import numpy as np


def sqd(a, b):
    return float(((np.asarray(a) - np.asarray(b)) ** 2).sum())


def kcenter(ids, X, k, first_idx=0):
    n = len(ids)
    chosen = [first_idx]
    m = np.array([sqd(X[i], X[first_idx]) for i in range(n)])
    mask = np.zeros(n, bool)
    mask[first_idx] = True
    for _ in range(1, k):
        best, bi = -1.0, -1
        for j in range(n):
            if not mask[j] and (m[j] > best or (m[j] == best and ids[j] < ids[bi])):
                best, bi = m[j], j
        chosen.append(bi)
        mask[bi] = True
        m = np.minimum(m, [sqd(X[i], X[bi]) for i in range(n)])
    return [ids[i] for i in chosen], m


def greedy_matching(ids, X, k):
    n = len(ids)
    if k >= n:
        return sorted(ids)
    cand = set(range(n))
    out = []
    order = sorted(range(n), key=lambda i: ids[i])
    for _ in range(k // 2):
        best = None
        for a, b in itertools.combinations(order, 2):
            if a in cand and b in cand:
                d = np.sqrt(sqd(X[a], X[b]))
                key = (d, -ids[a], -ids[b])
                if best is None or key > best[0]:
                    best = (key, a, b)
        _, a, b = best
        out += [ids[a], ids[b]]
        cand -= {a, b}
    if k % 2:
        out.append(min(ids[i] for i in cand))
    return out


def radius(X, centers):
    return max(min(np.sqrt(sqd(x, c)) for c in centers) for x in X)


def optimal_radius(X, k):
    return min(radius(X, [X[i] for i in comb]) for comb in itertools.combinations(range(len(X)), k))
