"""Token ids in Simple-8b: as many ids in each 64-bit word as its selector says.

A word holds a selector in its top 4 bits and 60 bits of equally wide ids, first id lowest. Selector 15
is an escape: the next word is one id as it is. Ids are coded in blocks of BLOCK; no word crosses a block, a block's last
word may be filled in part, and ``offsets`` tells where each block's words begin, so that blocks are
decoded independently and all words of a selector at once.

A token file is Parquet: a row per document, documents in ascending order of id within a file and from
file to file, each with its number of ids, the ids before it in its part, the block offsets and the
words (little-endian). Each part is one task's work and is written anew if that task is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveymill.llm.common import arrow_schema, runs, slices, work_folder
from surveymill.llm.tokens import END_ID, encoder, public_file

BLOCK = 1024
TOGETHER = 1_000_000  # bytes of text or words that are coded at a time: their arrays stay in the processor's cache
# Fixed values of the coding: ids to a word for the selectors 0 to 13; the width is 60 bits by that.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
_COUNTS = np.array(COUNTS)
_WIDTHS = 60 // _COUNTS
_REACH = max(COUNTS)


_SMALL = np.maximum(1, np.ceil(np.log2(np.arange(1, 2**17 + 1)))).astype(np.uint8)  # bits of the ids up to 2^17


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, 1 at least."""
    if len(ids) and ids.max() < len(_SMALL):
        return _SMALL[ids.astype(np.int64)]
    return np.searchsorted(np.uint64(1) << np.arange(1, 64, dtype=np.uint64), ids, side="right").astype(np.uint8) + 1


def encode(lists: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(offsets, words)`` of each list of unsigned ids: lists are cut into blocks and all blocks coded side by side."""
    ends = [[*range(BLOCK, len(x), BLOCK), len(x)] if len(x) else [] for x in lists]
    sizes = np.array([b - a for e in ends for a, b in zip([0, *e], e, strict=False)], np.int64)
    if not len(sizes):
        return [(np.zeros(0, np.int32), np.zeros(0, "<u8"))] * len(lists)
    # blocks with a gap of zero-width places after each, so that a word may look past its block's end
    begins = np.concatenate([[0], np.cumsum(sizes + _REACH)[:-1]])
    flat = np.concatenate(lists).astype(np.uint64)
    place = np.arange(len(flat)) + np.repeat(_REACH * np.arange(len(sizes)), sizes)
    ids = np.zeros(int(begins[-1] + sizes[-1]) + 2 * _REACH, np.uint64)
    widths = np.zeros(len(ids), np.uint8)
    ids[place], widths[place] = flat, _widths(flat)

    # the smallest selector, so the most ids, whose width holds all ids from a place on
    best = np.full(len(ids), ESCAPE, np.uint8)
    doubled = {1: widths}
    span = 1
    for selector in range(len(COUNTS) - 1, -1, -1):
        count, width = COUNTS[selector], 60 // COUNTS[selector]
        power = 1 << (count.bit_length() - 1)
        while span < power:
            wider = doubled[span].copy()
            np.maximum(doubled[span][:-span], doubled[span][span:], out=wider[:-span])
            span *= 2
            doubled[span] = wider
        most = doubled[power]
        if count > power:
            most = most.copy()
            most[: power - count] = np.maximum(most[: power - count], doubled[power][count - power :])
        np.copyto(best, np.uint8(selector), where=most <= width)

    steps = np.append(_COUNTS, [0, 1])  # 14 is not used; an escape takes one id
    stops, at, heads = begins + sizes, begins.copy(), []
    while len(at):
        heads.append(at)
        at = at + steps[best[at]]
        inside = at < stops
        at, stops = at[inside], stops[inside]
    heads = np.sort(np.concatenate(heads))
    chosen = best[heads].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector, count in enumerate(COUNTS):
        own = np.flatnonzero(chosen == selector)
        if len(own):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(60 // count)
            packed = ids[heads[own][:, None] + np.arange(count)] << shifts
            words[own] |= np.bitwise_or.reduce(packed, axis=1)
    raw = np.flatnonzero(chosen == ESCAPE)
    block_at = np.searchsorted(heads, begins)
    block_at = block_at + np.searchsorted(raw, block_at)
    words = np.insert(words, raw + 1, ids[heads[raw]]).astype("<u8")

    out, block = [], 0
    bounds = np.append(block_at, len(words))
    for e in ends:
        first, block = block, block + len(e)
        out.append(((bounds[first:block] - bounds[first]).astype(np.int32), words[bounds[first] : bounds[block]]))
    return out


def decode(lists: list[tuple[np.ndarray, np.ndarray, int]]) -> list[np.ndarray]:
    """The ids of each list ``(offsets, words, n)``; the words of all lists are decoded side by side."""
    counts = np.array([n for *_, n in lists], np.int64)
    ends = np.cumsum(counts)
    if not ends.size or not ends[-1]:
        return [np.zeros(0, np.uint64) for _ in lists]
    words = np.concatenate([words for _, words, _ in lists])
    first_word = np.cumsum([0, *(len(words) for _, words, _ in lists)])
    blocks = np.array([len(offsets) for offsets, *_ in lists], np.int64)
    of_list = np.repeat(np.arange(len(lists)), blocks)
    number = np.arange(len(of_list)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    # of every block: its first word, and where its ids start and stop in the output
    block_at = np.concatenate([offsets for offsets, *_ in lists]) + first_word[of_list]
    block_start = (ends - counts)[of_list] + number * BLOCK
    block_stop = np.minimum(block_start + BLOCK, ends[of_list])

    selectors = (words >> np.uint64(60)).astype(np.uint8)
    is_raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():  # rare: ids of more than 60 bits
        if not is_raw[at]:
            is_raw[at + 1] = True
    head = np.flatnonzero(~is_raw)
    chosen = selectors[head]
    nominal = np.append(_COUNTS, [0, 1])[chosen]
    before = np.cumsum(nominal) - nominal
    opening = np.searchsorted(head, block_at)
    heads = np.diff(np.append(opening, len(head)))
    start = before + np.repeat(block_start - before[opening], heads)
    real = np.minimum(nominal, np.repeat(block_stop, heads) - start)  # a block's last word may be filled in part
    ids = np.zeros(int(ends[-1]) + _REACH, np.uint64)
    by_selector = np.argsort(chosen, kind="stable")
    bounds = np.searchsorted(chosen[by_selector], np.arange(len(COUNTS) + 1))
    for selector, count in enumerate(COUNTS):
        own = by_selector[bounds[selector] : bounds[selector + 1]]
        packed, places, whole = words[head[own]], start[own], real[own]
        mask = np.uint64((1 << (60 // count)) - 1)
        for k in range(count):
            if k and (part := whole > k).sum() < len(packed):
                packed, places, whole = packed[part], places[part], whole[part]
            ids[places + k] = (packed >> np.uint64(k * (60 // count))) & mask
    raw = chosen == ESCAPE
    ids[start[raw]] = words[head[raw] + 1]
    return [ids[end - n : end] for end, n in zip(ends.tolist(), counts.tolist(), strict=True)]


# --- token files -------------------------------------------------------------------------------

FILE_COLUMNS = "part int, doc_id long, n_tokens long, before long, offsets array<int>, words binary"


def write_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID
) -> None:
    """Encode every whole text, add ``end_id`` to each, write the token files in ascending order of id.

    Defined cases: a null text counts as empty (one id, the end id); rows without id come first; rows that
    repeat an id follow one another; an empty table writes no rows; other columns are not read. Rows are
    dealt by ranges of (id, place in the input), so an id that a third of the rows share is spread too.
    """
    tokenizer = tokenizer or public_file()
    types = arrow_schema(FILE_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, encode_text = TaskContext.get().partitionId(), 0, encoder(tokenizer).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows, texts in slices(batch, 1, TOGETHER):
                lists = [np.frombuffer(encode_text(text) + end, "<u4") for text in texts]
                counts = np.array([len(x) for x in lists], np.int64)
                starts = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                coded = encode(lists)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lists), part, np.int32)),
                        rows.column(0),
                        pa.array(counts),
                        pa.array(starts),
                        pa.array([x for x, _ in coded], types.field("offsets").type),
                        pa.array([x.tobytes() for _, x in coded], pa.binary()),
                    ],
                    schema=types,
                )

    order = ["id", "place"]
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    sorted_rows.mapInArrow(run, FILE_COLUMNS).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(part, base)``: the ids before each part, from the number of ids in each (a row for each task that wrote)."""
    parts = _files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_COLUMNS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` decoded from token files; ids as little-endian unsigned 32-bit integers."""
    columns = "part int, doc_id long, n_tokens long, before long, ids binary"
    types = arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, batch.schema.get_field_index("words"), TOGETHER):
                lists = [
                    (np.asarray(offsets), np.frombuffer(words, "<u8"), n)
                    for offsets, words, n in zip(
                        part.column("offsets").to_pylist(), part.column("words").to_pylist(),
                        part.column("n_tokens").to_pylist(), strict=True,
                    )
                ]
                ids = [x.astype("<u4").tobytes() for x in decode(lists)]
                kept = [part.column(name) for name in ("part", "doc_id", "n_tokens", "before")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary())], schema=types)

    decoded = _files(spark, path).mapInArrow(run, columns)
    base = read_index(spark, path)  # as many rows as tasks wrote
    return decoded.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def token_files(docs: DataFrame, **how) -> DataFrame:
    """Write token files to the work folder and read them back."""
    path = work_folder(docs.sparkSession, "token-files")
    write_tokens(docs, path, **how)
    return read_tokens(docs.sparkSession, path)
