"""Packing token ids into windows of equal capacity by multiway differencing (Karmarkar-Karp).

A document's whole windows are windows as they are; what is left of it is cut into pieces of CUT ids
at most. A task collects pieces for WINDOWS windows and deals them out: every piece starts as a partial
partition of its own, the two partial partitions with the largest imbalance are merged again and again,
the fullest window of one with the emptiest of the other, until one is left, with near-equal windows. If
one of them exceeds the capacity, the number of windows rises by one and the pieces are dealt out anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.llm.common import arrow_schema, slices
from surveymill.llm.tokens import END_ID, encoder, public_file

CAPACITY = 1024
CUT = 256  # ids of a piece at most: four pieces and more to a window balance well
WINDOWS = 64  # windows that one run of differencing fills
SLACK = 12  # ids left free in each window, about what differencing leaves as imbalance
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Multiway differencing: the piece numbers of each window.

    A partial partition knows the two it was merged from and how their windows were paired; which window a piece ends in
    is read from the last merge back to the pieces.
    """
    heap = []
    for number, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, number, sums))
    heapq.heapify(heap)
    merges = []
    turn = len(sizes)
    while len(heap) > 1:
        _, a, a_sums = heapq.heappop(heap)
        _, b, b_sums = heapq.heappop(heap)
        sums = a_sums + b_sums[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        sums -= sums[-1]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(sums[0]), turn, sums))
        turn += 1
    if not heap:
        return []
    ends = {heap[0][1]: np.arange(windows)}  # of a partial partition: where each of its windows ends up
    for made, (a, b, order) in zip(range(turn - 1, len(sizes) - 1, -1), reversed(merges), strict=True):
        paired = np.empty(windows, np.int64)
        paired[order] = ends.pop(made)
        ends[a], ends[b] = paired, paired[::-1]
    dealt: list[list[int]] = [[] for _ in range(windows)]
    for number in range(len(sizes)):
        dealt[ends[number][0]].append(number)
    return [window for window in dealt if window]


def fill(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the total asks for, then one more until none is exceeded."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = difference(sizes, windows)
        if all(sum(sizes[i] for i in window) <= capacity for window in dealt):
            return dealt
        windows += 1


def cut(n: int, capacity: int, most: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: whole windows, then pieces of ``most`` ids at most."""
    whole = n // capacity * capacity
    pieces = [(start, capacity) for start in range(0, whole, capacity)]
    return pieces + [(start, min(most, n - start)) for start in range(whole, n, most)]


def _pack_task(batches, encode, end: bytes, capacity: int, most: int, windows: int, types: pa.Schema):
    """The pieces of a task's rows, each with its window; memory holds one run of differencing."""
    sequence = TaskContext.get().partitionId() << 32
    ready: list[tuple] = []
    loose: list[tuple] = []
    total, target = 0, windows * max(1, capacity - SLACK)

    def close():
        nonlocal sequence, loose, total
        for window in fill([piece[2] for piece in loose], capacity):
            offset = 0
            for number in sorted(window):
                ready.append((*loose[number], sequence, offset))
                offset += loose[number][2]
            sequence += 1
        loose, total = [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), types, strict=True)],
            schema=types,
        )

    for batch in batches:
        for rows, texts in slices(batch, 1):
            for doc_id, text in zip(rows.column(0).to_pylist(), texts, strict=True):
                ids = encode(text) + end
                n = len(ids) // 4
                for start, length in cut(n, capacity, most):
                    piece = (doc_id, start, length, ids[4 * start : 4 * (start + length)], n)
                    if length == capacity:
                        ready.append((*piece, sequence, 0))
                        sequence += 1
                        continue
                    loose.append(piece)
                    total += length
                    if total >= target:
                        close()
            if ready:
                yield batch_of(ready)
                ready.clear()
    if loose:
        close()
        yield batch_of(ready)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    windows: int = WINDOWS,
) -> DataFrame:
    """The pieces of all documents: ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``.

    Every id of a document, its end id included, lies in one piece; pieces of a sequence follow each other
    without gap from offset 0; ids are little-endian unsigned 32-bit integers. Rows are not moved: each
    task packs its own, so only a task's last run has windows with more room than differencing leaves.
    Defined cases: a null text counts as empty (its end id alone); rows without id, or that repeat an id, are
    documents of their own; a text of any length is cut as above; an empty table has no pieces; other
    columns are not read. The rows of a task must come in the same order if it is run again, as those of
    files do.
    """
    tokenizer = tokenizer or public_file()
    end, most, types = np.array([end_id], "<u4").tobytes(), max(1, min(CUT, capacity - 1)), arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pack_task(batches, encoder(tokenizer).encode, end, capacity, most, windows, types)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """``(sequence_id, length, ids)``: the windows for training, padded to ``capacity`` unless the length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    made = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    hexed = F.array_join(F.transform("parts", lambda part: F.hex(part["ids"])), "")
    pad = F.repeat(F.lit(np.array([pad_id], "<u4").tobytes().hex()), (F.lit(capacity) - F.col("length")).cast("int"))
    whole = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    return made.select("sequence_id", "length", F.unhex(F.concat(hexed, F.when(whole, "").otherwise(pad))).alias("ids"))
