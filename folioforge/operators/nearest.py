"""Exact nearest rows of a block of queries among a part of a corpus, in NumPy.

A matrix product gives scores with an error that is known; whatever could be among the k best within that error is scored
again, product by product in the order of the vector, so scores and ties are those of the column expressions.
"""

from __future__ import annotations

from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Scores held at once, and pairs scored again at once.
SCORES, PAIRS = 1 << 22, 1 << 16


class Lists:
    """Rows of one or more vectors of one size: layer j has the j-th vector of the rows that have one."""

    def __init__(self, column: pa.ListArray):
        flat = column.values.flatten().to_numpy(zero_copy_only=False)
        self.vectors = flat.reshape(len(column.values), -1)
        ends = column.offsets.to_numpy()
        self.starts, self.counts = ends[:-1], np.diff(ends)

    def __len__(self) -> int:
        return len(self.starts)

    def only(self, keep: np.ndarray) -> Lists:
        out = copy(self)
        out.starts, out.counts = self.starts[keep], self.counts[keep]
        return out

    def layer(self, j: int, lo: int = 0, hi: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows from lo to hi that have a j-th vector, and these vectors."""
        at = np.flatnonzero(self.counts[lo:hi] > j)
        return at, self.vectors[self.starts[lo:hi][at] + j].astype(np.float64)

    def copies(self, most: int) -> np.ndarray:
        """The rows without those that have ``most`` equal ones before them."""
        seen: dict[bytes, int] = {}
        keep = []
        for i, (s, n) in enumerate(zip(self.starts.tolist(), self.counts.tolist())):
            row = self.vectors[s : s + n].tobytes()
            c = seen.get(row, 0)
            if c < most:
                seen[row] = c + 1
                keep.append(i)
        return np.array(keep, dtype=np.int64)


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean norms, summed in the order of the vector."""
    s = np.zeros(len(x))
    for d in range(x.shape[1]):
        s += x[:, d] * x[:, d]
    return np.sqrt(s)


def rough(q: np.ndarray, x: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Scores (q, x), the greater the better, and by query how far off they and the exact ones can be.  In place of a
    distance stands 2 q x - x x, which puts a query's rows in the opposite order."""
    eps = 8 * (q.shape[1] + 8) * 2.0**-52
    a, b = lengths(q), lengths(x)
    if metric == "cosine":
        return (q / a[:, None]) @ (x / b[:, None]).T, np.full(len(q), eps)
    s = q @ x.T
    if metric == "euclid":
        s *= 2
        s -= (b * b)[None, :]
        return s, eps * (a + b.max()) ** 2
    return s, eps * a * b.max()


def exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray, metric: str) -> np.ndarray:
    """Scores of pairs, summed in the order of the vector; q and x by columns."""
    s = np.zeros(len(qi))
    for a, b in zip(q, x):
        if metric == "euclid":
            d = a[qi] - b[xi]
            s += d * d
        else:
            s += a[qi] * b[xi]
    return np.sqrt(s) if metric == "euclid" else s


def best(queries: Lists, corpus: Lists, metric: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, places of rows, scores: each query's k best rows; of equals those that come first."""
    single = metric != "max_sim"
    kept = corpus.copies(k)
    rows = corpus.only(kept)
    deep, wide = int(rows.counts.max()), int(queries.counts.max())
    layers = [rows.layer(j) for j in range(deep)]
    norms = lengths(layers[0][1]) if metric == "cosine" else None
    columns = [(np.cumsum(rows.counts > j) - 1, np.ascontiguousarray(x.T)) for j, (_, x) in enumerate(layers)]
    step = max(1, SCORES // len(rows))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(queries), step):
        counts = queries.counts[lo : lo + step]
        score, margin = np.zeros((len(counts), len(rows))), np.zeros(len(counts))
        parts = [queries.layer(i, lo, lo + step) for i in range(wide)]
        for at, q in parts:
            if not len(at):
                break
            most, off = np.full((len(at), len(rows)), -np.inf), np.zeros(len(at))
            for where, x in layers:
                s, e = rough(q, x, metric)
                if len(where) == len(rows):
                    np.maximum(most, s, out=most)
                else:
                    most[:, where] = np.maximum(most[:, where], s)
                off = np.maximum(off, e)
            score[at] += most
            # Sums of several have an error of their own.
            margin[at] += off * (1 if single else 1 + wide)
        # Not a number counts as greater than any.
        score[np.isnan(score)] = np.inf if metric == "cosine" else -np.inf
        if len(rows) > k:
            kth = np.partition(score, len(rows) - k, axis=1)[:, len(rows) - k]
            qi, xi = np.nonzero(score >= (kth - 2 * margin)[:, None])
        else:
            qi, xi = np.nonzero(np.ones_like(score, dtype=bool))
        value = np.zeros(len(qi))
        for i, (at, q) in enumerate(parts):
            if not len(at):
                break
            place, by_column = np.cumsum(counts > i) - 1, np.ascontiguousarray(q.T)
            own = lengths(q) if metric == "cosine" else None
            for p in range(0, len(qi), PAIRS):
                a, b = qi[p : p + PAIRS], xi[p : p + PAIRS]
                has = np.flatnonzero(counts[a] > i)
                top = np.full(len(has), -np.inf)
                for j, (position, x) in enumerate(columns):
                    both = np.flatnonzero(rows.counts[b[has]] > j)
                    s = exact(by_column, x, place[a[has[both]]], position[b[has[both]]], metric)
                    top[both] = np.maximum(top[both], s)
                if metric == "cosine":
                    top = top / (own[place[a[has]]] * norms[b[has]])
                value[p + has] += top
        order = value if metric == "euclid" else np.where(np.isnan(value), -np.inf, -value)
        o = np.lexsort((xi, order, qi))
        qi, xi, value = qi[o], xi[o], value[o]
        first = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        found.append((qi[first] + lo, kept[xi[first]], value[first]))
    return tuple(np.concatenate(x) for x in zip(*found))


def best_of_tables(queries: pa.Table, corpus: pa.Table, metric: str, k: int, key: str) -> pa.Table:
    """query_id, key, score of a block of queries (query_id, v) and a part of the corpus (key, v); v lists of vectors."""
    schema = pa.schema([("query_id", queries.schema.field("query_id").type), (key, corpus.schema.field(key).type), ("score", pa.float64())])
    if not len(queries) or not len(corpus):
        return schema.empty_table()
    corpus = corpus.take(pc.sort_indices(corpus, sort_keys=[(key, "ascending")]))
    one = lambda t: t["v"].combine_chunks()
    with np.errstate(all="ignore"):
        qi, xi, value = best(Lists(one(queries)), Lists(one(corpus)), metric, k)
    return pa.table([queries["query_id"].take(pa.array(qi)), corpus[key].take(pa.array(xi)), pa.array(value)], schema=schema)
