"""A set of queries against all vectors, in blocks: vectors stay in their block, queries come by.

Vectors are dealt over blocks by hash. A task holds one block at a time, makes its index once, and answers the queries a
few at a time as they come in, sorted behind the block's vectors. So vectors are moved once, queries once for
each block, and a task's memory is one block and a few queries. Blocks are as large as memory allows, so they are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveymill.llm.common import arrow_schema, stage

SMALLEST_BLOCK, LARGEST_BLOCK = 8192, 65536  # vectors; between them as many as keep all cores busy
QUERIES = 256  # queries that are in memory at a time

FOUND = "query_place long, query_id long, vec_id long, score {}"

#: The vectors of a block as a matrix -> its index; and (index, queries as a matrix, number of each query's own vector in the
#: block or -1, ids of the block's vectors, k) -> (query, vectors, scores) of each query.
MakeIndex = Callable[[np.ndarray], Any]
Answer = Callable[[Any, np.ndarray, np.ndarray, np.ndarray, int], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def matrix(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = rows.column("x")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 1))


def _search(batches: Iterator[pa.RecordBatch], make: MakeIndex, answer: Answer, k: int, types: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in order of block, length and kind (0 vector, 1 query)."""
    current, vectors, index = None, [], None
    places = ids = by_place = np.zeros(0, np.int64)
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in range(3)]
        bounds = np.flatnonzero(np.any([key[1:] != key[:-1] for key in keys], axis=0)) + 1
        for a, b in zip([0, *bounds.tolist()], [*bounds.tolist(), batch.num_rows], strict=True):
            group = (int(keys[0][a]), int(keys[1][a])) if batch.num_rows else None
            if group != current:
                current, vectors, index = group, [], None
            if group is not None and not keys[2][a]:
                vectors.append(batch.slice(a, b - a))
                continue
            if not vectors and index is None:
                continue  # no vectors of this length in the block
            if index is None:
                held = pa.Table.from_batches(vectors)
                index, vectors = make(matrix(held)), []
                places, ids = held["place"].to_numpy(), held["id"].to_numpy()
                by_place = np.argsort(places, kind="stable")
            for start in range(a, b, QUERIES):
                queries = batch.slice(start, min(QUERIES, b - start))
                place, query_id = queries.column("place").to_numpy(), queries.column("id").to_numpy()
                near = np.minimum(np.searchsorted(places[by_place], place), len(places) - 1)
                own = np.where(places[by_place][near] == place, by_place[near], -1)
                found = list(answer(index, matrix(queries), own, ids, k))
                asked = np.repeat([i for i, *_ in found], [len(v) for _, v, _ in found]).astype(np.int64)
                picked = np.concatenate([v for _, v, _ in found])
                columns = (place[asked], query_id[asked], ids[picked], np.concatenate([s for *_, s in found]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=types)


def search(
    rows: DataFrame, is_query: str, k: int, make: MakeIndex, answer: Answer, score: str, block_rows: int | None = None
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of all other rows for the rows ``(id, x)`` that meet ``is_query``.

    ``score`` is the type of the scores; higher ones are better, equal ones go to the smaller id. Rows meet rows of the same length
    only; a row is not its own answer, rows that repeat an id are rows of their own.
    """
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()), "search-vectors")  # places now stay
    n = rows.count()
    if block_rows is None:
        share = n // rows.sparkSession.sparkContext.defaultParallelism + 1
        block_rows = min(max(share, SMALLEST_BLOCK), LARGEST_BLOCK)
    blocks = max(1, -(-n // block_rows))

    def side(frame: DataFrame, block, kind: int) -> DataFrame:
        return frame.select(block.alias("block"), F.size("x").alias("dims"), F.lit(kind).alias("kind"), "place", "id", "x")

    own = F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    both = side(rows, own, 0).unionAll(side(rows.filter(is_query), every, 1))
    ddl = FOUND.format(score)
    types = arrow_schema(ddl)
    dealt = both.repartition(3 * blocks, "block").sortWithinPartitions("block", "dims", "kind")
    found = dealt.mapInArrow(lambda batches: _search(batches, make, answer, k, types), ddl)
    best_first = Window.partitionBy("query_place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
