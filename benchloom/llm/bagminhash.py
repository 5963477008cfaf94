"""BagMinHash: signatures of multisets with the collision rate of the weighted Jaccard similarity.

Every element e has a weight axis cut at 0, 1, 2, 4, 8, ... Each piece carries a Poisson process in time whose rate is
its length, driven by hashes of (e, piece) alone, so all documents see the same points. A point has a time, a slot of
the signature and a place on its piece: the halving of the piece that BagMinHash does level by level, read from the
bits of one hash. A document of weight w owns the points below w. In every slot the earliest owned point is the
signature; two documents agree in a slot with probability sum(min) / sum(max).

Only points up to a time limit are drawn; the limit is where all slots are filled with high probability, and documents
with an empty slot go again with twice the limit. The work per document is its elements plus about m log m points.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
C1, C2, C3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * C2
    x = (x ^ (x >> U(27))) * C3
    return x ^ (x >> U(31))


def processes(element: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One process for each started piece of each element: index of the element, start and length of the piece."""
    pieces = np.where(weight <= 1, 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1)
    which = np.repeat(np.arange(len(element)), pieces)
    level = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    return which, start, np.maximum(start, 1)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures (n_docs, m) of non-empty multisets given as (doc, element hash, weight) triples."""
    which, start, length = processes(element, weight)
    owner, top = doc[which], weight[which]
    seed = mix(element[which] + C1 * (start.astype(U) + U(1)))
    total = np.bincount(doc, weight, n_docs)
    limit = m / total * (np.log(m) + 3)
    out = np.zeros(n_docs * m, dtype=U)
    best = np.full(n_docs * m, np.inf)
    todo = np.arange(len(which))
    while len(todo):
        _draw(todo, owner, top, seed, start, length, limit, m, best, out)
        short = np.flatnonzero(np.isinf(best.reshape(n_docs, m)).any(axis=1))
        if not len(short):
            break
        limit[short] *= 2
        best.reshape(n_docs, m)[short] = np.inf
        again = np.zeros(n_docs, dtype=bool)
        again[short] = True
        todo = np.flatnonzero(again[owner])
    return out.reshape(n_docs, m)


def _draw(todo, owner, top, seed, start, length, limit, m, best, out, chunk=1 << 17):
    """All points up to the limits for the processes `todo`, blocks of points at a time."""
    mean = limit[owner[todo]] * length[todo]
    block = np.ceil(mean + 2 * np.sqrt(mean) + 1).astype(np.int64)
    edges = np.cumsum(block)
    at = 0
    while at < len(todo):
        stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + chunk, side="right")))
        _blocks(todo[at:stop], block[at:stop], owner, top, seed, start, length, limit, m, best, out)
        at = stop


def _blocks(p, n, owner, top, seed, start, length, limit, m, best, out):
    first = np.zeros(len(p), dtype=np.int64)
    before = np.zeros(len(p))
    while len(p):
        offset = np.cumsum(n) - n
        k = np.arange(n.sum()) - np.repeat(offset - first, n)
        ident = mix(np.repeat(seed[p], n) + C1 * (k.astype(U) + U(1)))
        gap = -np.log(((ident >> U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        unit = length[p].max() == 1
        if not unit:
            gap /= np.repeat(length[p], n)
        time = np.cumsum(gap)
        last = time[offset + n - 1]
        shift = before - (time[offset] - gap[offset])
        time += np.repeat(shift, n)
        last = last + shift
        lim = limit[owner[p]]
        own = np.flatnonzero(time <= np.repeat(lim, n))
        t, i = time[own], ident[own]
        cell = np.repeat(owner[p] * m, n)[own]
        more = mix(i)
        if not unit:
            row = np.repeat(p, n)[own]
            below = start[row] + (more >> U(40)).astype(np.int64) * length[row] // (1 << 24) < top[row]
            t, i, cell, more = t[below], i[below], cell[below], more[below]
        cell += ((more & U(0xFFFFFFFF)) * U(m) >> U(32)).astype(np.int64)
        np.minimum.at(best, cell, t)
        won = best[cell] == t
        out[cell[won]] = i[won]
        on = last <= lim
        p, first, before = p[on], (first + n)[on], last[on]
        n = np.maximum(4, n[on] // 4)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each run of `rows` slots."""
    n, m = signature.shape
    parts = signature[:, : m // rows * rows].reshape(n, m // rows, rows)
    key = np.broadcast_to(np.arange(m // rows, dtype=U), (n, m // rows)).copy()
    for r in range(rows):
        key = mix(key * C1 + parts[:, :, r])
    return key
