"""Whitening of vectors by a covariance put together from variances (polarisation).

A first pass adds up every dimension. With n vectors and sums S, y = n * x - S is n times the centred value, as a
whole number. A second pass adds up the squares of y for every dimension, and of y_i + y_j for every pair of
dimensions; no product of two dimensions is ever formed. Half the difference of these variances is the
covariance: 2 * sum(y_i y_j) = sum((y_i + y_j)^2) - sum(y_i^2) - sum(y_j^2). All of it is exact: a value is cut
into limbs whose squares a task can add in 64 bits, a task's sums are whole numbers of any size and Spark adds
decimals. Only the sums, one for each pair of dimensions, come to the driver, which takes their eigenvectors.

Vectors of different lengths are whitened each with those of their own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from surveymill.llm.common import arrow_schema

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
LIMB = 26  # bits of a limb: ROWS products of two add up within 64 bits
ROWS = 1024  # rows worked on at a time
DEGENERATE = 1e-12  # a component with a smaller share of the largest eigenvalue is none


@dataclass(frozen=True)
class Fit:
    """What is learned from the vectors of one length: ``scores = centred @ axes``."""

    n: int
    sums: list[int]
    reach: int  # no |y| is larger
    axes: np.ndarray  # a column for each component, divided by the root of its eigenvalue; 0 if degenerate
    explained: np.ndarray
    degenerate: np.ndarray


def whole_vectors(vectors: DataFrame, vector_col: str, scale: int, offset: int) -> DataFrame:
    """The rows whose vector is not null and holds no null, NaN or infinite entry, with it in whole numbers as ``_x``."""
    entries = vectors[vector_col].cast("array<double>")
    odd = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.filter(vectors[vector_col].isNotNull() & ~F.coalesce(odd, F.lit(True)))
    return kept.withColumn("_x", F.transform(entries, lambda c: F.floor(F.lit(float(scale)) * c) + F.lit(offset).cast("long")))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, matrix)`` of a column of lists for each length, ROWS rows at most."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for dims in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dims)
        for start in range(0, len(rows), ROWS):
            part = rows[start : start + ROWS]
            yield part, flat[offsets[part][:, None] + np.arange(dims)]


def centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """y = n * x - S, as Python's whole numbers where they may pass 62 bits."""
    kind = np.int64 if max(fit.reach, fit.n * int(np.abs(x).max(initial=0)), *map(abs, fit.sums)) < 2**62 else object
    return fit.n * x.astype(kind) - np.array(fit.sums, kind)


def sums_of_squares(values: np.ndarray, reach: int) -> list[int]:
    """Exact sums of squares of each column; no value's size is beyond ``reach``, and ROWS rows come at most."""
    if reach >= 2**62:
        return [sum(v * v for v in column) for column in values.T.tolist()]
    parts = [np.abs(values)]
    while reach >> (LIMB * len(parts)):
        parts[-1:] = [parts[-1] & (2**LIMB - 1), parts[-1] >> LIMB]
    totals = [0] * values.shape[1]
    for i, a in enumerate(parts):
        for j, b in enumerate(parts[: i + 1]):
            found = np.einsum("rc,rc->c", a, b).tolist()
            totals = [t + (f << (LIMB * (i + j) + (i != j))) for t, f in zip(totals, found, strict=True)]
    return totals


def _rows(found: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found, strict=True) if found else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)


def dimension_sums(x: DataFrame) -> dict[int, tuple[int, list[int], list[int], list[int]]]:
    """By length of the vectors: their number, and of each dimension the sum, the least and the largest value."""
    schema = "dims int, i int, n long, value decimal(38,0), least long, most long"
    types = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for rows, matrix in _matrices(batch.column(0)):
                totals.setdefault((matrix.shape[1], -1), [0, 0, 0, 0])[0] += len(rows)  # the number of vectors
                low, high = matrix & (2**32 - 1), matrix >> 32
                parts = zip(low.sum(0).tolist(), high.sum(0).tolist(), matrix.min(0).tolist(), matrix.max(0).tolist(), strict=True)
                for i, (lo, hi, least, most) in enumerate(parts):
                    own = totals.setdefault((matrix.shape[1], i), [0, 0, least, most])
                    own[:] = own[0] + len(rows), own[1] + lo + (hi << 32), min(own[2], least), max(own[3], most)
        yield _rows([(d, i, n, Decimal(s), a, b) for (d, i), (n, s, a, b) in totals.items()], types)

    added = x.select("_x").mapInArrow(run, schema).groupBy("dims", "i").agg(
        F.sum("n").alias("n"), F.sum("value").alias("value"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    out: dict[int, tuple] = {}
    for row in added.orderBy("dims", "i").collect():  # a row for each dimension
        _, sums, least, most = out.setdefault(row.dims, (row.n, [], [], []))
        if row.i >= 0:
            sums.append(int(row.value))
            least.append(row.least)
            most.append(row.most)
    return out


def pair_squares(x: DataFrame, fits: dict[int, Fit]) -> dict[int, np.ndarray]:
    """By length of the vectors: sum(y_i^2) on the diagonal, sum((y_i + y_j)^2) above it, as whole numbers."""
    schema = "dims int, i int, j int, value decimal(38,0)"
    types = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, matrix in _matrices(batch.column(0)):
                dims = matrix.shape[1]
                fit = fits[dims]
                y = centred(matrix, fit)
                for i in range(dims):
                    pairs = np.concatenate([y[:, i : i + 1], y[:, i : i + 1] + y[:, i + 1 :]], axis=1)
                    found = sums_of_squares(pairs, 2 * fit.reach)
                    own = totals.get((dims, i))
                    totals[dims, i] = found if own is None else [a + b for a, b in zip(own, found, strict=True)]
        yield _rows([(d, i, i + k, Decimal(v)) for (d, i), found in totals.items() for k, v in enumerate(found)], types)

    out = {dims: np.zeros((dims, dims), object) for dims in fits}
    added = x.select("_x").mapInArrow(run, schema).groupBy("dims", "i", "j").agg(F.sum("value").alias("value"))
    for row in added.collect():  # a row for each pair of dimensions
        out[row.dims][row.i, row.j] = int(row.value)
    return out


def covariance(squares: np.ndarray, n: int) -> np.ndarray:
    """The covariance of x from the sums of squares of y = n * x - S, each entry rounded once."""
    dims = len(squares)
    out = np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            twice = 2 * squares[i, i] if i == j else squares[i, j] - squares[i, i] - squares[j, j]
            out[i, j] = out[j, i] = twice / (2 * n**3)
    return out


def fitted(n: int, sums: list[int], reach: int, squares: np.ndarray, components: int) -> Fit:
    matrix = covariance(squares, n)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    degenerate = values <= DEGENERATE * max(values.max(initial=0), 0)
    axes = np.where(degenerate, 0, vectors / np.sqrt(np.where(degenerate, 1, values)))
    trace = float(np.trace(matrix))
    return Fit(n, sums, reach, axes, values / trace if trace > 0 else np.zeros(len(values)), degenerate)


def fit_all(x: DataFrame, components: int) -> dict[int, Fit]:
    out = {}
    for dims, (n, sums, least, most) in dimension_sums(x).items():
        reach = max((max(abs(n * a - s), abs(n * b - s)) for s, a, b in zip(sums, least, most, strict=True)), default=0)
        out[dims] = Fit(n, sums, reach, np.zeros((dims, 0)), np.zeros(0), np.zeros(0, bool))
    squares = pair_squares(x, out) if out else {}
    return {dims: fitted(f.n, f.sums, f.reach, squares[dims], components) for dims, f in out.items()}


def _scores(matrix: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """``(y, whitened)`` of a matrix of rows."""
    y = centred(matrix, fit)
    return y, (y / fit.n).astype(np.float64) @ fit.axes


def identity_errors(x: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By length: the largest entry of the whitened rows' own covariance less the identity, over all rows."""
    schema = "dims int, i int, j int, value double"
    types = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, matrix in _matrices(batch.column(0)):
                dims = matrix.shape[1]
                scores = np.hstack([_scores(matrix, fits[dims])[1], np.ones((len(matrix), 1))])  # sums in the last row
                totals[dims] = totals.get(dims, 0) + scores.T @ scores
        yield _rows([(d, i, j, v) for d, m in totals.items() for i, row in enumerate(m.tolist()) for j, v in enumerate(row)], types)

    out = {dims: np.zeros((len(fit.explained) + 1,) * 2) for dims, fit in fits.items()}
    for row in x.select("_x").mapInArrow(run, schema).groupBy("dims", "i", "j").agg(F.sum("value").alias("value")).collect():
        out[row.dims][row.i, row.j] = row.value / fits[row.dims].n
    errors = {}
    for dims, found in out.items():
        means = found[:-1, -1]
        off = np.abs(found[:-1, :-1] - np.outer(means, means) - np.eye(len(means)))
        errors[dims] = float(off[~fits[dims].degenerate][:, ~fits[dims].degenerate].max(initial=0))
    return errors


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """``(id, n, deviation, whitened, explained, identity_error)`` of every row whose vector is whole.

    An entry c counts as x = floor(scale * c) + offset. ``whitened`` holds, by falling eigenvalue of the covariance of x,
    the centred vector's projections over the roots of the eigenvalues, ``explained`` their shares of the trace, ``deviation`` the
    sum over dimensions of (n * x - S)^2 (exact, decimal(38,0)), ``identity_error`` what is measured on all rows.

    Defined cases: rows whose vector is null or holds a null, NaN or infinite entry neither count nor come back; rows
    without id, or that repeat one, are rows of their own; vectors are compared with those of the same length; an empty vector has
    no components; a component without variance (one vector, equal vectors, dependent dimensions) is null in ``whitened`` and
    left out of the identity; an empty table has no rows; other columns are not read.
    """
    rows = whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), "v", scale, offset)
    x = rows.select("id", "_x")
    fits = fit_all(x, components)
    errors = identity_errors(x, fits)
    added = "n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    schema = StructType([*x.select("id").schema.fields, *_parse_datatype_string(added).fields])
    types = arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in _matrices(batch.column(1)):
                fit = fits[matrix.shape[1]]
                y, scores = _scores(matrix, fit)
                if matrix.shape[1] * fit.reach * fit.reach < 2**63:
                    deviations = np.einsum("rc,rc->r", y, y).tolist()
                else:
                    deviations = [sum(v * v for v in row) for row in y.tolist()]
                size, dims = scores.shape
                ends = pa.array(np.arange(0, size * dims + 1, dims or 1, dtype=np.int32) if dims else np.zeros(size + 1, np.int32))
                gone = np.tile(fit.degenerate, size)
                whitened = pa.ListArray.from_arrays(ends, pa.array(scores.ravel(), mask=gone))
                explained = pa.ListArray.from_arrays(ends, pa.array(np.tile(fit.explained, size)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(np.full(size, fit.n)),
                        pa.array(list(map(Decimal, deviations)), types.field("deviation").type),
                        whitened.cast(types.field("whitened").type),
                        explained.cast(types.field("explained").type),
                        pa.array(np.full(size, errors[matrix.shape[1]])),
                    ],
                    names=["id", *types.names],
                )

    return x.mapInArrow(run, schema)
