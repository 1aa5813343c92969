"""The density search (K6) over a table that a task holds whole: rows are positions by ascending id.

The mutual-reachability forest grows by Boruvka rounds. In each, tasks look for the lightest outgoing edges of the rows of open
components; the largest component is never searched from inside, as its lightest edge is also one of another component.
Weights are bounded by products in single precision, and what the bounds can't decide is computed by direct differences.
"""

from __future__ import annotations

import numpy as np

from segmetric.operators.distance import Near, _local_roots, dealt, exact_distances, pair_distances

_COLUMNS = 4096


def lightest_edges(x: np.ndarray, kd: np.ndarray, comp: np.ndarray, rows: np.ndarray, max_w: float) -> tuple[np.ndarray, ...]:
    """(u, v, w) of the lightest edge out of the component of every row of ``rows`` that has one of at most ``max_w``;
    the weight is max(kd_u, kd_v, d)."""
    best, to = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
    square = np.where(np.isfinite(kd), kd, 0) ** 2
    for c in range(0, len(x), _COLUMNS):
        y, ky, cy = x[c:c + _COLUMNS], kd[c:c + _COLUMNS], comp[c:c + _COLUMNS]
        near = Near(x[rows], y, 2, single=True)
        parts = near.parts() if near.ok else ((s, pair_distances(x[rows[s:s + near.step]], y) ** 2, np.zeros(min(near.step, len(rows) - s)))
                                              for s in range(0, len(rows), near.step))
        far2, none = square[c:c + _COLUMNS].astype(near.left.dtype if near.ok else np.float64), ~np.isfinite(ky)
        for s, d, error in parts:
            d = np.maximum(d, far2, out=d)
            d[(comp[rows[s:s + len(d)], None] == cy) | none] = np.inf
            least = d.min(axis=1)
            have = best[s:s + len(d)]
            # a squared weight rounds by 1e-6 of itself at most where it is held in single precision
            slack = 2 * error + 1e-6 * np.where(np.isfinite(least), least, 0)
            ask = np.flatnonzero(np.isfinite(least) & (least - slack <= np.where(np.isfinite(have), have, 1e300) ** 2))
            if not len(ask):
                continue
            i, j = np.nonzero(d[ask] <= (least + slack)[ask, None])
            i = ask[i]
            w = np.maximum(ky[j], exact_distances(x, y, rows[i + s], j))
            order = np.lexsort((j, w, i))
            one = order[np.searchsorted(i[order], np.unique(i))]
            i, j, w = i[one], j[one], w[one]
            better = w < have[i]
            have[i[better]], to[i[better] + s] = w[better], c + j[better]
    w = np.maximum(best, kd[rows])
    ok = w <= max_w
    return rows[ok], to[ok], w[ok]


def _of_components(comp: np.ndarray, u, v, w) -> tuple[np.ndarray, ...]:
    order = np.lexsort((v, u, w, comp[u]))
    one = order[np.searchsorted(comp[u][order], np.unique(comp[u]))]
    return u[one], v[one], w[one]


def forest(spark, shared, kd: np.ndarray, max_w: float) -> tuple[np.ndarray, ...]:
    """(u, v, w): edges whose components under any bound on w are those of all pairs. ``shared``: broadcast vectors."""
    n = len(kd)
    comp, is_open, out = np.arange(n), np.isfinite(kd) & (kd <= max_w), []
    while True:
        sizes = np.bincount(comp, minlength=n)
        rows = np.flatnonzero(is_open & (comp != sizes.argmax()) if sizes.max() > 1 else is_open)
        if not len(rows):
            break
        state = spark.sparkContext.broadcast((kd, comp, rows))

        def search(a, b, state=state):
            kd, comp, rows = state.value
            return _of_components(comp, *lightest_edges(shared.value, kd, comp, rows[a:b], max_w))

        u, v, w = (np.concatenate(c) for c in zip(*dealt(spark, len(rows), search)))
        state.unpersist()
        if not len(u):
            break
        u, v, w = _of_components(comp, u, v, w)
        out.append((u, v, w))
        # a component without an edge has none in later rounds either, unless another one reaches it
        closed = np.setdiff1d(np.unique(comp[rows]), comp[u])
        is_open[np.isin(comp, closed)] = False
        comp = _local_roots(n, [(comp[u], comp[v])])[comp]
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def labels_at(eps: float, kd: np.ndarray, edges, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Clusters at one eps (-1: noise), numbered by their first core row. ``near``, ``far``: nearest rows (-1: none) and distances."""
    u, v, w = edges
    core = kd <= eps
    root = _local_roots(len(kd), [(u[w <= eps], v[w <= eps])])
    first = np.unique(root[core])
    out = np.full(len(kd), -1, np.int32)
    out[core] = np.searchsorted(first, root[core])
    # border rows: core rows strictly inside the row's own core distance
    b = np.flatnonzero(~core & np.isfinite(kd))
    j, d = near[b], far[b]
    ok = (j >= 0) & (d < kd[b, None]) & (d <= eps) & core[j]
    reach = np.where(ok, out[j], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
    out[b] = np.where(ok.any(axis=1), reach, -1)
    return out


def grid_labels(spark, x: np.ndarray, near: np.ndarray, far: np.ndarray, cands: list[tuple], ms_list: list[int]) -> np.ndarray:
    """Labels of all rows, a column a candidate (cand, eps, min_samples)."""
    kds = {m: far[:, m - 1] if m <= far.shape[1] else np.full(len(x), np.inf) for m in ms_list}
    max_eps = max(c[1] for c in cands)
    shared = spark.sparkContext.broadcast(x)
    edges = {m: forest(spark, shared, kds[m], max_eps) for m in ms_list}
    shared.unpersist()
    told = spark.sparkContext.broadcast((kds, edges, near, far))

    def label(c):
        kds, edges, near, far = told.value
        return labels_at(c[1], kds[c[2]], edges[c[2]], near, far).tobytes()

    found = spark.sparkContext.parallelize(cands, len(cands)).map(label).collect()
    told.unpersist()
    return np.column_stack([np.frombuffer(f, np.int32) for f in found])
