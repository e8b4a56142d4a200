"""Approximate neighbours: recall against brute force, exact scores, defined cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveymill.llm import collisions
from surveymill.llm.queries import QUERIES


def brute(rows, is_query, k):
    """By place of the query: its id, and all answers in order."""
    whole = [
        (i, [float(c) for c in v]) for i, v in rows
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    out = []
    for a, (query, q) in enumerate(whole):
        if is_query(query):
            others = [(i, v) for b, (i, v) in enumerate(whole) if b != a and len(v) == len(q)]
            scores = collisions.dot(np.array([v for _, v in others]).reshape(len(others), len(q)), np.array(q)).tolist()
            out.append((query, sorted((-s, i) for s, (i, _) in zip(scores, others, strict=True))[:k]))
    return out


def recall_and_check(got, rows, is_query, k):
    """The share of the true neighbours that was found; ids of queries must be unique."""
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(v)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
        q = np.array(vectors[r.query_id][0], float)
        assert r.score in {float(collisions.dot(np.array([v], float), q)[0]) for v in vectors[r.vec_id] if v and len(v) == len(q)}
    hits = total = 0
    for query, true in brute(rows, is_query, k):
        own = found.get(query, [])
        assert own == sorted(own) and len(own) == len(true)
        # equal scores are equally near
        least = true[-1][0] if true else 0
        hits += sum(s <= least for s, _ in own)
        total += len(true)
    return hits / max(total, 1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = QUERIES["op11_collision_counting_neighbours"](spark, folder).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert recall_and_check(got, rows, lambda i: i % 20 == 0, 20) >= 0.93


@pytest.mark.parametrize("block_rows", [None, 300])
def test_recall_on_clusters_of_all_norms(spark, block_rows):
    rng = random.Random(7)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(20)]
    rows = [(i, [s * (c + rng.gauss(0, 0.05)) for c in rng.choice(centres)]) for i in range(1500) for s in [rng.lognormvariate(0, 1)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = collisions.nearest_neighbours(frame, "id % 20 = 0", block_rows=block_rows).collect()
    assert recall_and_check(got, rows, lambda i: i % 20 == 0, 20) >= 0.9


def test_tight_clusters_are_read_in_part():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(200, 32))
    vectors = np.repeat(centres, 50, axis=0) + 0.02 * rng.normal(size=(10_000, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    block = collisions.Block(vectors)
    picked = np.arange(0, 10_000, 97)
    found = {i: set(v.tolist()) for i, v, _ in block.nearest(vectors[picked], picked, np.arange(10_000), 20)}
    exact = vectors[picked] @ vectors.T
    exact[np.arange(len(picked)), picked] = -np.inf
    true = np.argsort(-exact, axis=1)[:, :20]
    assert np.mean([len(found[i] & set(t.tolist())) / 20 for i, t in enumerate(true)]) >= 0.9
    pairs = len(picked) * len(vectors)
    assert block.verified < 0.05 * pairs and block.read < 0.2 * pairs * collisions.ARRAYS


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(11)
    base = [9 * rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(1, 400)]
    rows += [(1000 + i, base) for i in range(500)]  # one vector holds more than half of all rows
    rows += [(2000, None), (2020, [0.5, None] + [0.0] * 6), (2040, [math.nan] * 8), (2060, [math.inf] * 8), (2080, [0.0] * 8), (None, base)]
    rows += [(3000, [1.0, -2.0]), (3020, [2.0, 1.0]), (3040, []), (3060, [1e300, 1e300, 0.0]), (3080, [1e-300, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    frame = frame.withColumns({"id": F.lit("i"), "v": F.lit(0), "place": F.lit(1), "kind": F.lit(2), "block": F.lit(3)})
    got = collisions.nearest_neighbours(frame, "id % 20 = 0", 5).collect()
    assert recall_and_check(got, rows, lambda i: i % 20 == 0, 5) >= 0.9
    for query in range(1000, 1500, 20):  # equal scores: the smallest ids
        expected = [i for i in range(1000, 1006) if i != query][:5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == query] == expected
    assert {(r.query_id, r.vec_id) for r in got if r.query_id >= 3000} == {(3000, 3020), (3020, 3000), (3060, 3080), (3080, 3060)}


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]
    got = collisions.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "id = 0", 2).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1.0), (0, 1, 1, 1.0), (0, 2, 1, 1.0), (0, 2, 1, 1.0)]


def test_fewer_than_k_and_none(spark):
    frame = spark.createDataFrame([(0, [0.5, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 3.5])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, collisions.nearest_neighbours(frame, "id = 0").collect())) == [(0, 1, 2, 3.0), (0, 2, 1, 1.5)]
    assert collisions.nearest_neighbours(frame.limit(0), "id = 0").collect() == []
    assert collisions.nearest_neighbours(frame, "id > 9").collect() == []
    assert collisions.nearest_neighbours(frame.limit(1), "id = 0").collect() == []


def test_threshold_is_the_quantile():
    rng = np.random.default_rng(1)
    p = math.erf(collisions.WINDOW / math.sqrt(2))
    drawn = rng.binomial(collisions.ARRAYS, p, 200_000)
    least = collisions.threshold()
    assert (drawn < least).mean() <= collisions.MISS + 0.005 < (drawn <= least).mean() + 0.01
