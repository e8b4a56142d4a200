"""Exact top-k against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveymill.llm import topk


def brute(rows, is_query, k):
    whole = [
        (i, [math.floor(256 * c) for c in v]) for i, v in rows
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for a, (query, q) in enumerate(whole):
        if is_query(query):
            scores = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i) for b, (i, v) in enumerate(whole) if b != a and len(v) == len(q))
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [None, 40])
def test_random_vectors(spark, block_rows):
    rng = random.Random(block_rows or 1)
    centres = [[rng.gauss(0, 0.1) for _ in range(16)] for _ in range(6)]
    rows = []
    for i in range(400):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.03) for c in centre]))
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # equal scores
    rows += [(2000, None), (2050, [0.1, None] + [0.0] * 14), (2100, [math.nan] * 16), (2150, [math.inf] * 16), (None, rows[0][1])]
    rows += [(50, rows[3][1]), (50, rows[3][1]), (3000, [0.0] * 16), (3050, [1.0, -2.0]), (3100, [2.0, 1.0]), (3150, []), (3200, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    frame = frame.withColumns({"id": F.lit("i"), "x": F.lit(0), "place": F.lit(1), "score": F.lit(2)})
    got = topk.top_k(frame, "id % 50 = 0", 5, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0, 5)


def test_fewer_than_k_and_none(spark):
    frame = spark.createDataFrame([(0, [0.5, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 3.5])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(frame, "id = 0").collect()))
    assert got == [(0, 1, 2, 128 * -256 + 256 * 896), (0, 2, 1, 128 * 256 + 256 * 256)]
    assert topk.top_k(frame.limit(0), "id = 0").collect() == []
    assert topk.top_k(frame, "id > 9").collect() == []


def test_ties_at_the_cut(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, "id % 100 = 0", 3, block_rows=50)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, 3)


def test_lists_are_read_in_part_where_vectors_lie_in_clusters():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (40, 16)) * rng.choice([0.2, 1, 3], (40, 16))
    vectors = np.floor(256 * (np.repeat(centres, 100, axis=0) + 0.05 * rng.normal(size=(4000, 16)))).astype(np.int64)
    lists, picked = topk.Lists(vectors), np.arange(0, 4000, 41)
    got = {i: (v.tolist(), s.tolist()) for i, v, s in lists.best(vectors[picked], picked, np.arange(4000), 5)}
    for i, own in enumerate(picked.tolist()):
        scores = vectors @ vectors[own]
        order = [v for v in np.lexsort((np.arange(4000), -scores)).tolist() if v != own][:5]
        assert got[i] == (order, scores[order].tolist())
    assert lists.read < 0.35 * vectors.size * len(picked) and lists.resolved < 0.25 * len(vectors) * len(picked)


def test_each_query_resolves_few_vectors_and_reads_no_entry_twice():
    rng = np.random.default_rng(5)
    vectors = np.floor(64 * rng.normal(size=(3000, 24))).astype(np.int64)
    lists = topk.Lists(vectors)
    for query in vectors[:30]:
        before = lists.read
        left = lists.candidates(query, -1, 5)
        assert lists.read - before <= vectors.size
        assert set(np.argsort(-(vectors @ query), kind="stable")[:5].tolist()) <= set(left.tolist())
