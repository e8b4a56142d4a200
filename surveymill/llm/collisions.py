"""Approximate nearest neighbours by counting collisions of single projections.

Every vector of a block is projected on ARRAYS random directions, and each direction is an array sorted by projection:
one index for all queries and all radii. A query opens a window about its own projection in every array, of
half width WINDOW * R. A vector in the window collides. As R grows (virtual rehashing) the windows grow at both
ends, and only what is new in them is read and counted, or what is still outside of them where that is less. A vector
within distance R collides in each array with the same probability or more, so all but a share MISS of those within
R reach the collision threshold, a quantile of the binomial distribution. Vectors that reach it are verified by their
inner product. A query is done when its k-th best verified vector lies within R, or when every vector has been
verified: there is no cap on either, so the work adapts to the data and the recall does not. How far R grows follows
from the k-th best so far, for which the vectors that collide most in the first windows are verified at once.

Nearness by inner product becomes nearness by distance: all vectors of a block are lengthened to the largest norm
by a coordinate of their own, in which queries are zero.

Queries meet the blocks of vectors as ``blocks`` deals them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.llm import blocks

K = 20
ARRAYS = 64
WINDOW = 1.5  # half width of a window, for a radius of 1
MISS = 0.05  # share of the vectors at distance R that may fail the collision threshold; nearer ones fail less
GROWTH = 2.0  # of the radius from round to round, as long as fewer than k vectors are verified
NEXT = 0.85  # the radius after the first round, as a share of the distance of the k-th best so far
FIRST = 1 / 64  # share of the block that the first windows hold
FIRST_VERIFIED = 4  # times k vectors are verified after the first round
SEED = 20


@cache
def threshold(arrays: int = ARRAYS, window: float = WINDOW, miss: float = MISS) -> int:
    """The most collisions that a vector at distance R has with a probability of 1 - miss at least."""
    p = math.erf(window / math.sqrt(2))
    below = 0.0
    for count in range(arrays + 1):
        below += math.comb(arrays, count) * p**count * (1 - p) ** (arrays - count)
        if below > miss:
            return max(1, count)
    return arrays


def dot(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up from the first dimension to the last, so that equal vectors score alike."""
    total = np.zeros(len(vectors))
    for column, weight in zip(vectors.T, query.tolist(), strict=True):
        total = total + column * weight
    return total


class Block:
    """The sorted arrays of a block of vectors, none of them zero."""

    def __init__(self, vectors: np.ndarray, arrays: int = ARRAYS) -> None:
        self.vectors = vectors
        self._size = np.abs(vectors).max()  # entries of at most 1, so that squares stay in range
        scaled = vectors / self._size
        squares = np.einsum("ij,ij->i", scaled, scaled)
        self._longest = float(np.sqrt(squares.max()))
        own = np.sqrt(np.maximum(self._longest**2 - squares, 0))
        self._directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, arrays))
        projected = (np.column_stack([scaled, own]) @ self._directions).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self._scaled = scaled.astype(np.float32)
        self.read = 0  # entries of arrays that were counted
        self.verified = 0  # inner products that were made

    def _windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows begin and end: a row for each array, a column for each query."""
        begin = [np.searchsorted(a, c - half, "left") for a, c in zip(self.sorted, at, strict=True)]
        end = [np.searchsorted(a, c + half, "right") for a, c in zip(self.sorted, at, strict=True)]
        return np.array(begin), np.array(end)

    def _first_half(self, at: np.ndarray, k: int) -> np.ndarray:
        """For each query, the median over the arrays of the half width that holds the first share of the block."""
        n = self.sorted.shape[1]
        reach = max(k, round(FIRST * n)) // 2 + 1
        places = np.array([np.searchsorted(a, c) for a, c in zip(self.sorted, at, strict=True)])
        ends = [np.take_along_axis(self.sorted, np.clip(places + d, 0, n - 1), axis=1) for d in (-reach, reach)]
        return np.median((ends[1] - ends[0]) / 2, axis=0)

    def nearest(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(query, vectors, scores)``: the k nearest found for each query, nearest first, equal ones by smaller id.

        own: number of the query's own vector in the block, -1 if it is in another.
        """
        n, least = len(self.vectors), threshold(len(self.sorted))
        norms = np.sqrt(np.einsum("ij,ij->i", q := queries / np.abs(queries).max(axis=1, keepdims=True), q))
        asked = q / norms[:, None]  # of length 1
        at = (self._longest * asked @ self._directions[:-1]).T
        radius = np.maximum(self._first_half(at, k) / WINDOW, 1e-6 * self._longest)
        wanted, arrays = min(k, n), len(self.sorted)
        counts = np.zeros((len(queries), n), np.int16)
        scores = np.full((len(queries), n), -np.inf, np.float32)
        seen = np.zeros((len(queries), n), bool)
        here = np.flatnonzero(own >= 0)
        seen[here, own[here]] = True
        n_seen = seen.sum(axis=1)

        def verify(i: int, found: np.ndarray) -> None:
            seen[i, found] = True
            scores[i, found] = self._scaled[found] @ asked[i]
            n_seen[i] += len(found)
            self.verified += len(found)

        active, rounds = np.arange(len(queries)), 0
        begin = end = np.array([np.searchsorted(a, c) for a, c in zip(self.sorted, at, strict=True)])
        while len(active):
            lo, hi = self._windows(at[:, active], WINDOW * radius[active])
            new, outside = ((begin - lo) + (hi - end)).sum(axis=0), arrays * n - (hi - lo).sum(axis=0)
            left = []
            for column, i in enumerate(active.tolist()):
                inner = [x[:, column].tolist() for x in (lo, begin, end, hi)]
                if new[column] <= outside[column]:
                    parts = [p for a, b0, b1, e0, e1 in zip(self.order, *inner, strict=True) for p in (a[b0:b1], a[e0:e1])]
                    counts[i] += np.bincount(np.concatenate(parts), minlength=n).astype(np.int16)
                else:
                    parts = [p for a, b0, e1 in zip(self.order, inner[0], inner[3], strict=True) for p in (a[:b0], a[e1:])]
                    counts[i] = arrays - np.bincount(np.concatenate(parts), minlength=n)
                self.read += int(min(new[column], outside[column]))
                verify(i, np.flatnonzero((counts[i] >= least) & ~seen[i]))
                if not rounds and n_seen[i] < n:
                    others = np.where(seen[i], -1, counts[i])
                    most = min(FIRST_VERIFIED * k, n - int(n_seen[i]))
                    verify(i, np.argpartition(others, n - most)[n - most :])
                if n_seen[i] < n:
                    if n_seen[i] - (own[i] >= 0) < wanted:
                        radius[i] *= GROWTH
                        left.append(column)
                        continue
                    kth = float(np.partition(scores[i], n - wanted)[n - wanted])
                    distance = math.sqrt(max(0.0, 2 * self._longest * (self._longest - kth))) * (1 + 1e-6)
                    if distance > radius[i]:  # vectors as near as the k-th may still be outside; none farther is asked for
                        radius[i] = distance if rounds else max(radius[i], NEXT * distance)
                        left.append(column)
                        continue
                yield i, *self._best(scores[i], queries[i], ids, k)
            active, begin, end, rounds = active[left], lo[:, left], hi[:, left], rounds + 1

    def _best(self, scores: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of what was verified by their exact scores; what rounding may have hidden is looked at too."""
        margin = 1e-6 * self._longest * math.sqrt(len(query))  # verified in single precision
        if (scores > -np.inf).sum() > k:
            near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - margin)
        else:
            near = np.flatnonzero(scores > -np.inf)
        exact = dot(self.vectors[near], query)
        top = np.lexsort((ids[near], -exact))[:k]
        return near[top], exact[top]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)`` of the rows with an id whose vector is not null, not zero and holds no null, NaN or infinite entry."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(odd, F.lit(True))
    return rows.filter(whole).filter(F.exists("x", lambda c: c != 0))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: str,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of all other rows for each row that meets ``is_query``.

    ``is_query`` is an SQL condition on ``id``; the score is the inner product in double precision, equal scores go to the
    smaller id. A block holds ``block_rows`` vectors, by default what keeps all cores busy within fixed limits. Defined
    cases: rows left out by ``usable`` neither ask nor answer; a row is not its own answer, but rows that repeat an id are
    rows of their own, ask each and find each other; vectors are compared with those of the same length; a query with
    fewer than k others gets all of them; an empty table has no answers; other columns are not read.
    """
    return blocks.search(usable(vectors, id_col, vector_col), is_query, k, Block, Block.nearest, "double", block_rows)
