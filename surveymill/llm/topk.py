"""Exact top-k by inner product with no random access to the vectors (NRA aggregation).

Each dimension of a block of vectors is a list sorted by value. A query reads every list from its best end, downwards
for a positive weight and upwards for a negative one, and the lists that can add most to a score farthest. Each step
reads the next slice of every list and adds it to the sums of the vectors met there; nothing is read twice. What has been
read of a vector, and how far each list has come, bound its score: unread parts are at best the list's
frontier and at worst its other end. Vectors whose upper bound is below the k-th best lower bound are out, and reading
stops when few are left (or the lists are at their ends). Only then are vectors looked up: the scores of those left are
resolved exactly.

Bounds of all vectors are a product of matrices, so they are looked at only if those of a few vectors show that
some may go. They are in floating point and widened by their rounding error; scores are integers and are computed as such.

Queries meet the blocks of vectors as ``blocks`` deals them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.llm import blocks

K = 5
SCALE = 256
FIRST = 1 / 16  # share of the lists that the first step reads; each further step reads as far again
LEFT = 1 / 4  # scores are resolved once at most this share of a block is left
LOOKED_AT = 32  # vectors whose bounds tell whether those of all are worth their while


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, x)``: floor(scale * component) as longs. Rows without id, and vectors that are null or hold
    null, NaN or infinite components, are left out."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(odd, F.lit(True)))
    return whole.select("id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"))


class Lists:
    """The sorted lists of a block of vectors; ``read`` counts the entries read, ``resolved`` the scores made."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        columns = vectors.T.astype(np.float64)
        self.order = np.argsort(columns, axis=1, kind="stable")
        self.values = np.take_along_axis(columns, self.order, axis=1)
        self.place = np.empty(self.order.shape, np.int32)  # of each vector in each list
        np.put_along_axis(self.place, self.order, np.arange(len(vectors), dtype=np.int32)[None, :], axis=1)
        self.read = self.resolved = 0
        # room that all queries use again: fresh memory costs more than what is done in it
        self._mask, self._unmet = np.empty(self.order.shape, bool), np.empty(self.order.shape)
        self._added = np.empty(len(vectors))

    def candidates(self, query: np.ndarray, own: int, k: int) -> np.ndarray:
        """Vectors that may be among the k best, by reading the lists."""
        n, weights = len(self.vectors), query.astype(np.float64)
        others = n - (own >= 0)
        lists = np.flatnonzero(weights)
        if others <= k or not len(lists):
            return np.flatnonzero(np.arange(n) != own)
        weights = weights[lists]
        lowest, highest = self.values[lists, 0], self.values[lists, -1]
        margin = (np.abs(weights) @ np.maximum(np.abs(lowest), np.abs(highest)) + 1) * (len(lists) + 2) * 2.0**-50
        at_worst = weights * np.where(weights > 0, lowest, highest)
        pull = np.abs(weights) * (highest - lowest)
        pull = pull / pull.mean() if pull.any() else np.ones(len(lists))
        depth = np.zeros(len(lists), np.int64)
        place = self.place if len(lists) == len(self.place) else self.place[lists]
        sums, down = np.zeros(n), (weights > 0)[:, None]
        share, few = FIRST, np.arange(0, n, max(1, n // LOOKED_AT))
        while True:
            ends = np.minimum(n, np.maximum(depth, np.ceil(share * n * np.maximum(pull, FIRST)).astype(np.int64)))
            for j, (number, a, b) in enumerate(zip(lists.tolist(), depth.tolist(), ends.tolist(), strict=True)):
                if b > a:
                    piece = slice(n - b, n - a) if weights[j] > 0 else slice(a, b)
                    added = np.multiply(self.values[number, piece], weights[j], out=self._added[: b - a])
                    np.add.at(sums, self.order[number, piece], added)
            self.read += int((ends - depth).sum())
            depth, share = ends, 2 * share
            frontier = weights * np.where(weights > 0, self.values[lists, n - depth], self.values[lists, depth - 1])
            bounds = np.stack([frontier, at_worst])

            def bound(picked, bounds=bounds, depth=depth[:, None]):
                places = place[:, picked]
                rows, columns = places.shape
                mask, unmet = (r[:rows, :columns] if columns <= n else np.empty(places.shape, r.dtype) for r in (self._mask, self._unmet))
                np.less(places, np.where(down, n - depth, depth), out=mask)
                np.copyto(unmet, np.not_equal(mask, ~down, out=mask))
                unread = bounds @ unmet
                return sums[picked] + unread[0] + margin, sums[picked] + unread[1] - margin

            done = bool((depth == n).all())
            if not done:
                leading = np.argpartition(sums, n - k - 1)[n - k - 1 :]  # one more than k: the own may be among them
                leading = leading[leading != own]
                best, worst = bound(np.concatenate([leading, few]))
                if (best[len(leading) :] >= np.sort(worst[: len(leading)])[-k]).mean() > 2 * LEFT:
                    continue
            best, worst = bound(slice(None))
            if own >= 0:
                best[own] = worst[own] = -np.inf
            left = np.flatnonzero((best >= np.partition(worst, n - k)[n - k]) & (best > -np.inf))
            if done or len(left) <= max(4 * k, LEFT * n):
                return left

    def best(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(query, vectors, scores)`` of the k best of each query, equal scores by smaller id."""
        for i, query in enumerate(queries):
            left = self.candidates(query, int(own[i]), k)
            self.resolved += len(left)
            scores = self.vectors[left] @ query
            top = np.lexsort((ids[left], -scores))[:k]
            yield i, left[top], scores[top]


def top_k(
    vectors: DataFrame,
    is_query: str,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for each row that meets ``is_query``.

    ``is_query`` is an SQL condition on ``id``. The score is the inner product of the vectors as integers,
    equal scores go to the smaller id. Defined cases: rows left out by ``quantised`` neither ask nor answer;
    a row is not its own answer, but rows that repeat an id are rows of their own, ask each and find
    each other; vectors are compared with those of the same length; a query with fewer than k others gets
    all of them; an empty table has no answers; other columns are not read.
    """
    rows = quantised(vectors, id_col, vector_col)
    return blocks.search(rows, is_query, k, Lists, Lists.best, "long", block_rows)
