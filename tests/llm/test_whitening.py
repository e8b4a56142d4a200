"""Whitening against exact fractions and numpy's own covariance."""

from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveymill.llm import whitening
from surveymill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def exact(vectors, scale=64, offset=10**6):
    """``(x, sums, covariance)`` with whole numbers and fractions."""
    x = [[math.floor(scale * c) + offset for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(dims)]
    centred = [[Fraction(row[i]) - Fraction(sums[i], n) for i in range(dims)] for row in x]
    matrix = [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dims)] for i in range(dims)]
    return x, sums, np.array(matrix)


def check(rows, vectors, components):
    """rows: ``(id, n, deviation, whitened, explained, identity_error)`` of the vectors by id."""
    x, sums, matrix = exact([v for _, v in vectors])
    n, values = len(x), np.sort(np.linalg.eigvalsh(matrix))[::-1][:components]
    deviations = sorted((i, sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for (i, _), row in zip(vectors, x, strict=True))
    assert sorted((r[0], int(r[2])) for r in rows) == deviations
    assert all(r[1] == n and r[5] < 1e-9 for r in rows)
    for r in rows:
        assert np.allclose(r[4], values / np.trace(matrix), rtol=1e-9)
    whitened = np.array([r[3] for r in sorted(rows, key=lambda r: r[0])])
    assert np.allclose(whitened.T @ whitened / n, np.eye(whitened.shape[1]), atol=1e-9)
    # the projections belong to the eigenvectors of their eigenvalues: the covariance gives them back
    by_id = sorted(zip(vectors, x, strict=True), key=lambda p: p[0][0])
    centred = np.array([row for _, row in by_id], float) - np.array(sums) / n
    axes = np.linalg.lstsq(centred, whitened, rcond=None)[0]
    assert np.allclose(matrix @ axes, axes * values, atol=1e-7 * values[0])


@pytest.mark.parametrize("size", [1.0, 1e4, 1e9])
def test_random_vectors(spark, size):
    rng = random.Random(size)
    mix = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    vectors = []
    for i in range(300):
        raw = [rng.gauss(0, 1) for _ in range(6)]
        vectors.append((i, [size * sum(a * b for a, b in zip(row, raw, strict=True)) + 5 * size for row in mix]))
    odd = [(900, None), (901, [1.0, None] + [0.0] * 4), (902, [math.nan] * 6), (903, [math.inf] * 6)]
    frame = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").repartition(4)
    frame = frame.withColumns({"id": F.lit("a"), "_x": F.lit(1), "n": F.lit(None).cast("void"), "v": F.lit(2)})
    for components in (6, 3):
        check([tuple(r) for r in whitening.whiten(frame, components=components).collect()], vectors, components)


def test_given_vectors(spark):
    got = QUERIES["op12_polarisation_whitening"](spark, SF_DIR).collect()
    given = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    rows = {}
    for r in sorted(got, key=lambda r: (r.vec_id, r.component)):
        row = rows.setdefault(r.vec_id, (r.vec_id, r.n, r.deviation, [], [], r.identity_error))
        row[3].append(r.whitened)
        row[4].append(r.explained)
    assert all(len(r[3]) == 32 for r in rows.values())
    check(list(rows.values()), given, 32)


def test_repeated_ids_lengths_and_no_variance(spark):
    rows = [(1, [1.0, 2.0]), (1, [3.0, 1.0]), (None, [0.0, 0.5]), (2, [7.0]), (3, []), (4, [1.0, 1.0, 2.0]), (5, [1.0, 1.0, 2.0]), (6, [2.0, 2.0, 2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by_n = {}
    for r in got:
        by_n.setdefault((len(r.whitened), r.n), []).append(r)
    assert {k: len(v) for k, v in by_n.items()} == {(2, 3): 3, (1, 1): 1, (0, 1): 1, (3, 3): 3}
    assert by_n[1, 1][0].whitened == [None] and by_n[1, 1][0].deviation == 0 and by_n[1, 1][0].explained == [0.0]
    assert by_n[0, 1][0].id == 3 and by_n[0, 1][0].deviation == 0
    for r in by_n[3, 3]:  # all on one line
        assert r.whitened[0] is not None and r.whitened[1:] == [None, None] and abs(r.explained[0] - 1) < 1e-12
    assert sorted(map(str, (r.id for r in by_n[2, 3]))) == ["1", "1", "None"]
    assert all(r.identity_error < 1e-9 for r in got)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(frame).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], frame.schema)).collect() == []


@pytest.mark.parametrize("bits", [3, 25, 26, 27, 40, 53, 61, 62, 70])
def test_sums_of_squares_are_exact(bits):
    rng = random.Random(bits)
    values = [[rng.choice([-1, 1]) * rng.getrandbits(bits) for _ in range(3)] for _ in range(whitening.ROWS)]
    values[0] = [2**bits - 1, 1 - 2**bits, 0]
    kind = np.int64 if bits < 63 else object
    got = whitening.sums_of_squares(np.array(values, kind), 2**bits - 1)
    assert got == [sum(v * v for v in column) for column in zip(*values, strict=True)]
    assert all(Decimal(v) == v for v in got)
