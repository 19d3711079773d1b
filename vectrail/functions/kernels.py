"""Array work inside tasks: Arrow batches in, numpy arrays out.

Spark partitions and shuffles the rows; these helpers only do the arithmetic
of one batch.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distances are compared after rounding, so that exact copies of a vector tie
# whatever order the sums were taken in; the id then decides.
TIE_DECIMALS = 12


def matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list array as a double matrix, and which rows fitted.

    NULL vectors, vectors of another length and vectors with NULL elements do
    not fit; their rows are NaN.
    """
    n = len(vectors)
    out = np.full((n, width), np.nan)
    valid = np.asarray(vectors.is_valid()) & (np.diff(vectors.offsets.to_numpy()) == width)
    flat = (vectors if valid.all() else vectors.filter(pa.array(valid))).flatten()
    out[valid] = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    if flat.null_count:
        holes = np.asarray(flat.is_null()).reshape(-1, width).any(axis=1)
        broken = np.flatnonzero(valid)[holes]
        valid[broken] = False
        out[broken] = np.nan
    return out, valid


def _directions(rows: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def distances(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Distance of every query (axis 0) to every row (axis 1); NaN if undefined."""
    if metric == "inner_product":
        return -(queries @ rows.T)
    if metric == "cosine":
        return 1.0 - _directions(queries) @ _directions(rows).T
    out = np.empty((len(queries), len(rows)))
    for i, query in enumerate(queries):
        gap = rows - query
        out[i] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


class Nearest:
    """The k nearest rows seen so far, per query.

    Memory is bounded by queries times k, whatever the number of rows.  Products in single precision
    tell which rows may be in reach, for a block of queries at a time; only those are measured, in
    double precision.
    """

    QUERIES, ROWS = 512, 2048  # of a block of products, which stays in a core's cache

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.queries, self.k, self.metric = queries, k, metric
        self.measured = _directions(queries) if metric == "cosine" else queries
        self.dist = np.full((len(queries), k), np.inf)
        self.ids = None  # of the type of the rows' keys
        self.found = np.zeros(len(queries), dtype=np.int64)
        # A row further away than this cannot be among the k nearest any more.
        self.reach = np.full(len(queries), np.inf)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(ids) or not len(self.queries) or self.k < 1:
            return
        if self.ids is None:
            self.ids = np.empty(self.dist.shape, dtype=ids.dtype)
        elif self.ids.dtype != ids.dtype:
            self.ids = self.ids.astype(np.promote_types(self.ids.dtype, ids.dtype))
        if self.metric == "cosine":
            rows = _directions(rows)
        # Small steps at first, so that few rows are measured before reach is known.
        start, step = 0, max(16, 2 * self.k)
        while start < len(ids):
            part = slice(start, start + step)
            judge = _Judge(rows[part], self.metric)
            for first in range(0, len(self.queries), self.QUERIES):
                block = slice(first, first + self.QUERIES)
                at, places = judge.perhaps_within(self.measured[block], self.reach[block])
                for some in range(0, len(at), 1 << 18):
                    few = slice(some, some + (1 << 18))
                    self._measure(at[few] + first, ids[part], rows[part], places[few])
            start, step = start + step, min(4 * step, self.ROWS)

    def _measure(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, places: np.ndarray) -> None:
        ours, theirs = self.measured[at], rows[places]
        with np.errstate(invalid="ignore", over="ignore"):
            if self.metric == "l2":
                gap = theirs - ours
                dist = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            else:
                dist = np.einsum("ij,ij->i", ours, theirs)
                dist = -dist if self.metric == "inner_product" else 1.0 - dist
        near = dist <= self.reach[at]  # false for NaN
        if near.any():
            self._merge(at[near], np.round(dist[near], TIE_DECIMALS), ids[places[near]])

    def _merge(self, at: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        """Queries ``at`` have new rows; those kept so far compete with them."""
        changed = np.unique(at)
        held = np.arange(self.k) < self.found[changed][:, None]
        row, place = np.nonzero(held)
        at = np.concatenate([changed[row], at])
        dist = np.concatenate([self.dist[changed[row], place], dist])
        ids = np.concatenate([self.ids[changed[row], place], ids])
        order = np.lexsort((ids, dist, at))
        at, dist, ids = at[order], dist[order], ids[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        at, place = at[kept], place[kept]
        if ids.dtype != self.ids.dtype:  # a longer text than any before
            self.ids = self.ids.astype(ids.dtype)
        self.dist[at, place], self.ids[at, place] = dist[kept], ids[kept]
        self.found[changed] = np.bincount(np.searchsorted(changed, at), minlength=len(changed))
        full = changed[self.found[changed] == self.k]
        self.reach[full] = self.dist[full, -1] + 10.0**-TIE_DECIMALS

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query positions, ids and distances, nearest first."""
        at, place = np.nonzero(np.arange(self.k) < self.found[:, None])
        ids = np.empty(0, dtype=np.int64) if self.ids is None else self.ids[at, place]
        return at, ids, self.dist[at, place]

    def rows(self):
        """(query position, id, distance) triples."""
        for i, key, dist in zip(*self.arrays()):
            yield i, key, float(dist)


class _Judge:
    """Which of some rows may be within reach of queries, by products that may lose digits.

    Rows near the limit, and rows that cannot be judged, are let through.
    """

    LARGE = 1e6  # beyond, single precision is left alone

    def __init__(self, rows: np.ndarray, metric: str):
        self.rows, self.metric, self.width = rows, metric, rows.shape[1]
        with np.errstate(invalid="ignore", over="ignore"):
            self.squares = np.einsum("ij,ij->i", rows, rows)
        self.turned: dict[type, np.ndarray] = {}  # by precision
        self.small = bool(np.abs(rows).max(initial=0.0) < self.LARGE)  # false with NaN

    def perhaps_within(self, queries: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.small and bool(np.abs(queries).max(initial=0.0) < self.LARGE):
            near = self._near(queries, reach, np.float32)
            # Long vectors that differ little are told apart in double precision.
            if np.isinf(reach).any() or np.count_nonzero(near) * 32 <= near.size:
                return np.divmod(np.flatnonzero(near), near.shape[1])
        near = self._near(queries, reach, np.float64)
        return np.divmod(np.flatnonzero(near), near.shape[1])

    def _near(self, queries: np.ndarray, reach: np.ndarray, kind: type) -> np.ndarray:
        if kind not in self.turned:
            self.turned[kind] = np.ascontiguousarray(self.rows.T.astype(kind))
        with np.errstate(invalid="ignore", over="ignore", under="ignore"):
            products = queries.astype(kind) @ self.turned[kind]
            own = np.einsum("ij,ij->i", queries, queries)
            most = np.nanmax(self.squares, initial=0.0)
            # What rounding every step of a product, and a term below the smallest number, may make of it.
            slip = 2.0 * (self.width + 8) * np.finfo(kind).eps
            if self.metric == "l2":
                # |q - r| <= reach where qr - rr / 2 >= (qq - reach^2) / 2: one comparison per query and row.
                products -= (self.squares / 2).astype(kind)
                least = (own - reach**2) / 2 - slip * (own + most)
            else:
                least = (1.0 - reach if self.metric == "cosine" else -reach) - slip * np.sqrt(own * most)
            least = (least - (self.width + 8) * np.finfo(np.float32).tiny).astype(kind)
            return ~(products < np.nextafter(least, -np.inf, dtype=kind)[:, None])  # true for NaN


class TermLists:
    """Per term of a part of the texts, the texts that hold it and the saturated counts.

    A text is the place of its key in ``keys``, which are sorted, so that ties fall to the smaller key.
    """

    SLACK = 1e-9  # ranks are rounded to fewer digits than bounds
    PAIRS = 1 << 21  # pairs of set and text held at a time, unless one set has more

    def __init__(self, keys: pa.Array, terms: pa.Array, counts: pa.Array):
        distinct = keys.unique()
        self.keys = distinct.take(pc.sort_indices(distinct))
        texts = pc.index_in(keys, value_set=self.keys).to_numpy(zero_copy_only=False)
        coded = terms.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.terms = coded.dictionary
        order = np.lexsort((texts, codes))
        self.texts = texts[order]
        self.shares = 1.0 - 1.0 / (counts.to_numpy(zero_copy_only=False)[order].astype(np.float64) + 1.0)
        self.starts = np.searchsorted(codes[order], np.arange(len(self.terms) + 1))
        self.sizes = np.diff(self.starts)
        self.most = np.maximum.reduceat(self.shares, self.starts[:-1])
        self.sheet = np.zeros(len(self.keys))  # one list spread over all texts, zero between uses

    def best(self, sets: pa.ListArray, least: np.ndarray, k: int):
        """The k best texts of every set that hold all its terms and reach its ``least``.

        Yields arrays: places of the sets, places of the texts, ranks.
        """
        asked = pc.index_in(sets.flatten(), value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False)
        lengths = sets.value_lengths().to_numpy(zero_copy_only=False)
        begins = np.cumsum(lengths) - lengths
        for n in np.unique(lengths[lengths > 0]):
            places = np.flatnonzero(lengths == n)
            terms = asked[begins[places][:, None] + np.arange(n)]
            some = (terms >= 0).all(axis=1)
            places, terms = places[some], terms[some]
            some = self.most[terms].sum(axis=1) >= (least[places] - self.SLACK) * n
            places, terms = places[some], terms[some]
            # The rarest term leads; sets with the same second term stand together.
            terms = np.take_along_axis(terms, np.argsort(self.sizes[terms], axis=1, kind="stable"), axis=1)
            if n > 1:
                order = np.argsort(terms[:, 1], kind="stable")
                places, terms = places[order], terms[order]
            filled = np.cumsum(self.sizes[terms[:, 0]])
            start = 0
            while start < len(places):
                before = filled[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(filled, before + self.PAIRS, "right")))
                part = slice(start, end)
                yield self._best_of(places[part], terms[part], least[places[part]], k)
                start = end

    def _best_of(self, places: np.ndarray, terms: np.ndarray, least: np.ndarray, k: int):
        n = terms.shape[1]
        sizes = self.sizes[terms[:, 0]]
        which = np.repeat(np.arange(len(places)), sizes)
        at = np.arange(len(which)) + np.repeat(self.starts[terms[:, 0]] - (np.cumsum(sizes) - sizes), sizes)
        least = (least - self.SLACK) * n
        others = self.most[terms[:, 1:]].sum(axis=1)
        total = self.shares[at]
        kept = total >= (least - others)[which]
        which, texts, total = which[kept], self.texts[at[kept]], total[kept]
        for column in range(1, n):
            if column > 1:
                order = np.argsort(terms[which, column], kind="stable")
                which, texts, total = which[order], texts[order], total[order]
            share = self._shares_of(terms[which, column], texts)
            kept = share > 0
            which, texts, total = which[kept], texts[kept], (total + share)[kept]
        kept = total >= least[which]
        which, texts, ranks = which[kept], texts[kept], np.round(total[kept] / n, TIE_DECIMALS)
        if n > 2:
            order = np.argsort(which, kind="stable")
            which, texts, ranks = which[order], texts[order], ranks[order]
        kept = np.ones(len(which), dtype=bool)
        ends = np.searchsorted(which, np.arange(len(places) + 1))
        for i in np.flatnonzero(np.diff(ends) > 2 * k):  # cut before the sort
            own = slice(ends[i], ends[i + 1])
            kept[own] = ranks[own] >= np.partition(ranks[own], -k)[-k]
        which, texts, ranks = which[kept], texts[kept], ranks[kept]
        order = np.lexsort((texts, -ranks, which))
        which, texts, ranks = which[order], texts[order], ranks[order]
        top = np.arange(len(which)) - np.searchsorted(which, which) < k
        return places[which[top]], texts[top], ranks[top]

    def _shares_of(self, terms: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """The saturated count of a term in a text, pair by pair; 0 where it is absent.  Equal terms stand together."""
        found = np.empty(len(terms))
        cuts = [0, *(np.flatnonzero(np.diff(terms)) + 1).tolist(), len(terms)] if len(terms) else []
        for a, b in zip(cuts, cuts[1:]):
            own = slice(self.starts[terms[a]], self.starts[terms[a] + 1])
            held, shares = self.texts[own], self.shares[own]
            if (b - a) * 8 < len(held):
                place = np.minimum(np.searchsorted(held, texts[a:b]), len(held) - 1)
                found[a:b] = np.where(held[place] == texts[a:b], shares[place], 0.0)
            else:
                self.sheet[held] = shares
                found[a:b] = self.sheet[texts[a:b]]
                self.sheet[held] = 0.0
        return found


def list_counts(
    lists: pa.ListArray, forms: Iterable[tuple[pa.Array, pa.Array]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """How often each term comes in each list: places of the lists, codes of the terms, counts, in this order, and the terms.

    ``forms`` are blocks of words, each word once, and of the term of each; other elements, and NULL lists, count nothing.
    """
    coded = lists.flatten().dictionary_encode()
    found, named = [np.empty(0, dtype=np.int64)], [pa.array([], pa.string())]
    for words, terms in forms:
        at = pc.index_in(words, value_set=coded.dictionary)
        found.append(at.drop_null().to_numpy(zero_copy_only=False))
        named.append(terms.filter(at.is_valid()).cast(pa.string()))
    named = pa.concat_arrays(named).dictionary_encode()
    term_of = np.full(len(coded.dictionary) + 1, -1, dtype=np.int64)  # the last is that of NULL
    term_of[np.concatenate(found)] = named.indices.to_numpy(zero_copy_only=False)
    codes = term_of[coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)]
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    places = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)[codes >= 0]
    span = max(len(named.dictionary), 1)
    pairs, counts = np.unique(places * span + codes[codes >= 0], return_counts=True)
    return pairs // span, pairs % span, counts, named.dictionary


def coded_vectors(codes: pa.Array, dims: int, cells_at_once: int = 1 << 22) -> pa.Array:
    """Feature-hashed unit vectors (Weinberger et al. 2009) of lists of word codes.

    A code is twice the slot of a word, plus one where its sign is negative.  A NULL list gives
    NULL, an empty one the zero vector.  The vectors are written a bounded number of cells at a time.
    """
    flat = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    slots, signs = flat >> 1, 1.0 - 2.0 * (flat & 1)
    lengths = codes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    missing = codes.is_null()
    parts = []
    rows = max(1, cells_at_once // dims)
    for start in range(0, len(codes), rows):
        n = min(rows, len(codes) - start)
        part = slice(ends[start], ends[start + n])
        cells = np.repeat(np.arange(n), lengths[start : start + n]) * dims + slots[part]
        parts.append(_unit_vectors(cells, signs[part], n, dims, missing.slice(start, n)))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))


def _unit_vectors(cells: np.ndarray, weights: np.ndarray, n: int, dims: int, missing: pa.Array) -> pa.Array:
    dense = np.bincount(cells, weights=weights, minlength=n * dims)
    dense = dense.astype(np.float64).reshape(n, dims)  # integers if there was no word
    lengths = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, lengths, out=np.zeros_like(dense), where=lengths > 0)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dims)
    values = pa.array(dense.astype(np.float32).ravel())
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(missing.to_numpy(zero_copy_only=False)))
