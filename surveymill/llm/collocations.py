"""Phrase collocation mining: phrases counted in counting quotient filters, scored, ranked for each language.

Words that are frequent in their language are numbered, texts become rows of word numbers (0: a word that no
frequent phrase can hold, or the end of a piece), and phrases are counted length by length. A phrase of k numbers is a code
of k * width bits. Four Feistel rounds permute the codes of a length, so that they spread evenly and can be
turned back. A permuted code is its quotient, the top bits, which says where an entry belongs, and the full
remainder: nothing is hashed away, so counts are exact and an entry gives its phrase back.

Each task keeps one filter, a sorted one with a counter for each entry. Full filters leave it cut by ranges of the
quotient; filters of a range meet in one task, which merges them as they are sorted. Ranges are so many that each
holds a bounded number of words of the corpus, and permuted codes fall evenly on them whatever phrases there are.

A phrase can only be frequent if its two parts one word shorter are. These are kept as a bitmap of fixed size that
all tasks of the next length look into: a bit set by chance lets a phrase be counted for nothing, none is lost.
"""

from __future__ import annotations

import pickle
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveymill.llm.common import arrow_schema, slices, stage

MIN_COUNT = 100
MAX_WORDS = 5
SCALE = 1000
CONTAINED = 100  # a phrase goes if a longer one that holds it is as frequent, in percent
TOP = 2000
NO_LANG = "und"

KEPT_WORDS = 300_000  # distinct words a task counts before it hands them on
DICTIONARY_WORDS, DICTIONARY_BYTES = 1_000_000, 32_000_000  # largest dictionary that every worker holds
FILTER_ENTRIES = 2_000_000  # entries of a task's filter
PENDING = 1_000_000  # codes that wait to be entered together
RANGE_WORDS = 20_000_000  # words of the corpus for each range of the quotient
BITMAP_BITS = 26

# The end of a piece, and what ends one. The mark occurs in no UTF-8 text.
_GAP = b"\xff"
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _GAP * 10)
_ROUNDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a gap for each end of a piece."""
    marked = text.encode().lower().translate(_ENDS)
    return marked.replace(_GAP, b" \xff ").split()


# --- codes ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Codes:
    """Codes of phrases of ``k`` words whose numbers take ``width`` bits: two halves of ``half`` bits."""

    k: int
    width: int

    @property
    def half(self) -> int:
        return -(-self.k * self.width // 2)

    @property
    def _mask(self) -> np.uint64:
        return np.uint64(2**self.half - 1)

    def pack(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the codes of phrases given by their first, second ... words."""
        high, low = np.zeros_like(numbers[0]), np.zeros_like(numbers[0])
        up, over = np.uint64(self.width), np.uint64(self.half - self.width)
        for column in numbers:
            high = ((high << up) | (low >> over)) & self._mask
            low = ((low << up) | column) & self._mask
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The phrases of codes, a row each."""
        out = np.zeros((len(high), self.k), np.uint64)
        down, over = np.uint64(self.width), np.uint64(self.half - self.width)
        for column in range(self.k - 1, -1, -1):
            out[:, column] = low & np.uint64(2**self.width - 1)
            low = ((low >> down) | (high << over)) & self._mask
            high = high >> down
        return out

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * _ROUNDS[1]
        x = (x ^ (x >> np.uint64(29))) * _ROUNDS[2]
        return (x ^ (x >> np.uint64(32))) & self._mask

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in _ROUNDS:
            high, low = low, high ^ self._mix(low, key)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(_ROUNDS):
            high, low = low ^ self._mix(high, key), high
        return high, low


# --- filters -------------------------------------------------------------------------------------


@dataclass
class Filter:
    """Distinct codes in ascending order, in two halves, with their counts."""

    half: int
    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, half: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> Filter:
        """A filter of codes in any order, equal ones added up."""
        if 2 * half <= 64:
            whole = (high << np.uint64(half)) | low
            order = np.argsort(whole, kind="stable")
            new = np.append(True, whole[order][1:] != whole[order][:-1])
        else:
            order = np.lexsort((low, high))
            new = np.append(True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]))
        if not len(order):
            return cls(half, high, low, counts)
        first = np.flatnonzero(new)
        return cls(half, high[order][first], low[order][first], np.add.reduceat(counts[order], first))

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        """One filter of several: their entries are runs in order, which the stable sort takes as such."""
        columns = [np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts")]
        return cls.of(filters[0].half, *columns)

    def __len__(self) -> int:
        return len(self.high)

    def ranges(self, bits: int) -> Iterator[tuple[int, Filter]]:
        """The filter cut by the top ``bits`` of its codes: ``(range, filter)``."""
        of = self.high >> np.uint64(self.half - bits)
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist() if len(of) else []
        for a, b in zip(starts, [*starts[1:], len(of)], strict=False):
            yield int(of[a]), Filter(self.half, self.high[a:b], self.low[a:b], self.counts[a:b])

    def to_bytes(self, taken: int) -> bytes:
        """Occupied quotients and ends of runs as bits, then remainders, then counters.

        The ``taken`` top bits are the range's and not written. The quotient has as many bits as make a slot for
        each entry. A counter is a byte; one of 255 and more is 255 there and follows in full.
        """
        n = len(self)
        rest = self.half - taken
        bits = min(rest, max(0, n - 1).bit_length())
        inner = self.high & np.uint64((1 << rest) - 1)
        quotient = (inner >> np.uint64(rest - bits)).astype(np.int64) if rest - bits < 64 else np.zeros(n, np.int64)
        remainder = inner & np.uint64((1 << (rest - bits)) - 1)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
        large = self.counts >= 255
        return b"".join([
            struct.pack("<IBI", n, bits, int(large.sum())),
            np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
            _narrow(remainder, rest - bits), _narrow(self.low, self.half),
            np.minimum(self.counts, 255).astype(np.uint8).tobytes(), self.counts[large].astype("<u8").tobytes(),
        ])

    @classmethod
    def from_bytes(cls, data: bytes, half: int, taken: int, range_: int) -> Filter:
        n, bits, n_large = struct.unpack_from("<IBI", data)
        rest, at = half - taken, 9

        def part(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.flatnonzero(np.unpackbits(part(-(-(1 << bits) // 8)), count=1 << bits))
        ends = np.unpackbits(part(-(-n // 8)), count=n).astype(np.int64)
        quotient = occupied[np.cumsum(ends) - ends].astype(np.uint64)
        remainder = _wide(part(n * -(-(rest - bits) // 8)), rest - bits, n)
        low = _wide(part(n * -(-half // 8)), half, n)
        counts = part(n).astype(np.int64)
        counts[counts == 255] = part(8 * n_large).view("<u8").astype(np.int64)
        high = remainder
        if bits:
            high = high | (quotient << np.uint64(rest - bits))
        if taken:
            high = high | np.uint64(range_ << rest)
        return cls(half, high, low, counts)


def _narrow(x: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits in as few whole bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _wide(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if bits:
        out[:, : -(-bits // 8)] = data.reshape(n, -1)
    return out.view("<u8").ravel().astype(np.uint64)


# --- words ---------------------------------------------------------------------------------------


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of ``(lang, text)`` rows; a task adds up its words before they move."""
    schema = "lang string, word string, n long"
    types = arrow_schema(schema)

    def batch_of(counted: dict[str, Counter]) -> pa.RecordBatch:
        columns = (
            [lang for lang, words in counted.items() for _ in words],
            [word.decode() for words in counted.values() for word in words],
            [n for words in counted.values() for n in words.values()],
        )
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, Counter] = {}
        for batch in batches:
            for part, texts in slices(batch, 1):
                for lang, text in zip(part.column(0).to_pylist(), texts, strict=True):
                    counted.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, counted.values())) > KEPT_WORDS:
                    for words in counted.values():
                        words.pop(_GAP, None)
                    yield batch_of(counted)
                    counted = {}
        for words in counted.values():
            words.pop(_GAP, None)
        yield batch_of(counted)

    return rows.mapInArrow(run, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered_words(counts: DataFrame, min_count: int) -> DataFrame:
    """``(lang, word, n, id)`` of the frequent words, ids from 1 without gaps: each task numbers its own, and its base
    is the number of words of the tasks before (a row for each task that wrote)."""
    own = F.monotonically_increasing_id()
    kept = counts.filter(F.col("n") >= min_count).withColumns({"part": F.shiftright(own, 33), "place": own.bitwiseAND(2**33 - 1)})
    kept = stage(kept, "phrases-frequent")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = kept.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    number = (F.col("base") + F.col("place") + 1).cast("int")
    return stage(kept.join(F.broadcast(bases), "part").select("lang", "word", "n", number.alias("id")), "phrases-words")


@cache
def _dictionary(data: bytes) -> dict[str, dict[bytes, int]]:
    """The worker's dictionary by language, made once from what was broadcast."""
    found: dict[str, dict[bytes, int]] = {}
    for lang, word, number in zip(*pickle.loads(data), strict=True):
        found.setdefault(lang, {})[word.encode()] = number
    return found


def _ids(text: str, numbers: dict[bytes, int]) -> np.ndarray:
    words = words_of(text)
    get = numbers.get
    return np.fromiter((get(word, 0) for word in words), np.int32, len(words))


_ENCODED = "ids array<int>"


def _encoded_batch(rows: list[np.ndarray], types: pa.Schema) -> pa.RecordBatch:
    ends = np.append(0, np.cumsum([len(x) for x in rows])).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(types.field(0).type)], schema=types)


def encoded_by_broadcast(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``(ids)`` of ``(lang, text)`` rows. The caller checks the size of ``words``."""
    found = words.select("lang", "word", "id").toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps([found[c].to_pylist() for c in ("lang", "word", "id")]))
    types = arrow_schema(_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_langs = _dictionary(shared.value)
        for batch in batches:
            for part, texts in slices(batch, 1):
                langs = part.column(0).to_pylist()
                yield _encoded_batch([_ids(text, of_langs.get(lang, {})) for lang, text in zip(langs, texts, strict=True)], types)

    return rows.mapInArrow(run, _ENCODED)


def encoded_by_join(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The same for a dictionary of any size: the distinct words of each row are joined to their numbers.

    The dictionary has a row for each word, so Spark can split the rows of a word that all texts hold.
    """
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "phrases-rows")
    schema = "row long, lang string, word string"
    types, encoded_types = arrow_schema(schema), arrow_schema(_ENCODED)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, 1):
                found = [
                    (row, lang, word.decode())
                    for lang, text, row in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), strict=True)
                    for word in set(words_of(text)) - {_GAP}
                ]
                columns = zip(*found, strict=True) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, 0):
                known = [{k.encode(): v for k, v in entry or []} for entry in part.column(1).to_pylist()]
                yield _encoded_batch([_ids(text, numbers) for text, numbers in zip(texts, known, strict=True)], encoded_types)

    pairs = rows.select("lang", "text", "row").mapInArrow(spread, schema).join(words.select("lang", "word", "id"), ["lang", "word"])
    own = pairs.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("word", "id"))).alias("known"))
    return rows.join(own, "row", "left").select("text", "known").mapInArrow(run, _ENCODED)


# --- phrases -------------------------------------------------------------------------------------


def _slots(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Places of permuted codes in the bitmap."""
    x = (high ^ (low * _ROUNDS[0])) * _ROUNDS[3]
    return (x ^ (x >> np.uint64(31))) & np.uint64(2**BITMAP_BITS - 1)


def _phrases_in(batch: pa.RecordBatch, codes: Codes, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Permuted codes of all phrases of a batch of number rows whose shorter parts may be frequent."""
    column = batch.column(0)
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    ids = np.zeros(int(lengths.sum()) + len(lengths), np.uint64)  # a gap after each row
    at = np.arange(len(ids) - len(lengths)) + np.repeat(np.arange(len(lengths)), lengths)
    ids[at] = flat[offsets[0] : offsets[-1]]
    k = codes.k
    whole = ids > 0
    ok = whole[: max(0, len(ids) - k + 1)].copy()
    for i in range(1, k):
        ok &= whole[i : i + len(ok)]
    starts = np.flatnonzero(ok)
    if frequent is not None:
        shorter = Codes(k - 1, codes.width)
        for part in (0, 1):
            slots = _slots(*shorter.permute(*shorter.pack([ids[starts + part + i] for i in range(k - 1)])))
            bits = frequent[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)
            starts = starts[(bits & 1).astype(bool)]
    return codes.permute(*codes.pack([ids[starts + i] for i in range(k)]))


def phrase_counts(encoded: DataFrame, codes: Codes, range_bits: int, min_count: int, frequent: np.ndarray | None) -> DataFrame:
    """``(ids, n, slot)`` of the phrases of ``codes.k`` words that are frequent."""
    shared = None if frequent is None else encoded.sparkSession.sparkContext.broadcast(frequent)
    taken = min(range_bits, codes.half)
    pieces = "range long, filter binary"
    types = arrow_schema(pieces)

    def cut(whole: Filter) -> pa.RecordBatch:
        found = [(number, part.to_bytes(taken)) for number, part in whole.ranges(taken)]
        columns = zip(*found, strict=True) if found else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared is None else shared.value
        empty = np.zeros(0, np.uint64)
        own, waiting, n_waiting = Filter(codes.half, empty, empty, np.zeros(0, np.int64)), [], 0

        def entered() -> Filter:
            high, low = (np.concatenate(x) for x in zip(*waiting, strict=True))
            return Filter.merged([own, Filter.of(codes.half, high, low, np.ones(len(high), np.int64))])

        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                found = _phrases_in(batch.slice(start, 1000), codes, bitmap)
                waiting.append(found)
                n_waiting += len(found[0])
                if n_waiting > PENDING:
                    own, waiting, n_waiting = entered(), [], 0
                    if len(own) > FILTER_ENTRIES:
                        yield cut(own)
                        own = Filter(codes.half, empty, empty, np.zeros(0, np.int64))
        if waiting:
            own = entered()
        if len(own):
            yield cut(own)

    counted = "ids array<int>, n long, slot long"
    counted_types = arrow_schema(counted)

    def frequent_of(filters: list[Filter]) -> pa.RecordBatch:
        whole = Filter.merged(filters)
        kept = np.flatnonzero(whole.counts >= min_count)
        high, low = whole.high[kept], whole.low[kept]
        ids = codes.unpack(*codes.restore(high, low)).astype(np.int32)
        ends = np.arange(0, ids.size + 1, codes.k, dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.ravel())).cast(counted_types.field(0).type)
        slot = _slots(high, low).astype(np.int64)
        return pa.RecordBatch.from_arrays([lists, pa.array(whole.counts[kept]), pa.array(slot)], schema=counted_types)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Filter] = []
        current, size = None, 0
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != current:
                    if held:
                        yield frequent_of(held)
                    held, current, size = [], number, 0
                held.append(Filter.from_bytes(data, codes.half, taken, number))
                size += len(held[-1])
                if size > 2 * len(held[0]) + PENDING:  # entries that repeat are added up as they come
                    held = [Filter.merged(held)]
                    size = len(held[0])
        if held:
            yield frequent_of(held)

    filters = encoded.mapInArrow(count, pieces).repartition("range").sortWithinPartitions("range")
    return filters.mapInArrow(merge, counted)


def _bitmap(counted: DataFrame) -> np.ndarray:
    """The slots of frequent phrases as bits: at most 2**BITMAP_BITS of them, whatever the corpus."""
    one = F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")
    found = counted.groupBy(F.expr("slot DIV 64").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(2**BITMAP_BITS // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def _enough(words: DataFrame) -> tuple[int, bool]:
    """Number of frequent words, and whether their dictionary may be held by every worker."""
    n, size = words.agg(F.count("*"), F.sum(F.octet_length("word"))).first()
    return n, n <= DICTIONARY_WORDS and (size or 0) <= DICTIONARY_BYTES


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def scored(counted: list[DataFrame], words: DataFrame, totals: DataFrame, scale: int, contained: int, top: int) -> DataFrame:
    """The best phrases of each language. counted: ``(ids, n)`` of the frequent phrases of 2, 3 ... words."""
    longest = len(counted) + 1
    candidates = _union([f.select("ids", F.col("n").alias("a")) for f in counted])
    inside = [
        f.select(F.slice("ids", start, length).alias("ids"), F.col("n").alias("longer"))
        for k, f in enumerate(counted, 2)
        for length in range(2, k)
        for start in range(1, k - length + 2)
    ]
    if inside:
        longer = _union(inside).groupBy("ids").agg(F.max("longer").alias("longer"))
        candidates = candidates.join(longer, "ids", "left")
        lost = F.lit(100).cast("decimal(4,0)") * F.col("longer") >= F.lit(contained).cast("decimal(9,0)") * F.col("a")
        candidates = candidates.filter(~F.coalesce(lost, F.lit(False))).drop("longer")
    known = _union([words.select(F.array("id").alias("ids"), "n"), *[f.select("ids", "n") for f in counted]])
    cut = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("cut")
    halves = candidates.select("ids", "a", cut).withColumns({
        "first": F.slice("ids", F.lit(1), F.col("cut")), "rest": F.slice("ids", F.col("cut") + 1, F.lit(longest)), "word": F.expr("ids[0]"),
    })
    halves = (
        halves.join(known.select(F.col("ids").alias("first"), F.col("n").alias("l")), "first")
        .join(known.select(F.col("ids").alias("rest"), F.col("n").alias("r")), "rest")
        .join(words.select(F.col("id").alias("word"), "lang"), "word")
        .join(totals, "lang")
    )
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "total")}
    value = F.call_function("div", F.lit(scale).cast("decimal(9,0)") * exact["a"] * exact["total"], exact["l"] * exact["r"])
    cuts = halves.select("lang", "ids", "a", "total", F.struct(value.alias("score"), "cut", "l", "r").alias("cut"))
    worst = cuts.groupBy("lang", "ids", "a", "total").agg(F.min("cut").alias("cut"))
    worst = worst.select("lang", "ids", "a", F.col("total").alias("n"), "cut.l", "cut.r", "cut.score")
    # all that tie with the last one stay until their words decide
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    worst = stage(worst.withColumn("near", F.rank().over(near)).filter(F.col("near") <= top).drop("near"), "phrases-best")
    spelled = (
        worst.select("ids", F.posexplode("ids").alias("place", "id")).join(words.select("id", "word"), "id")
        .groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.join(spelled, "ids").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    scale: int = SCALE,
    contained: int = CONTAINED,
    top: int = TOP,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    Pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; A-Z are lower-cased. ``a`` counts a phrase of 2 to ``max_words``
    words within pieces, overlaps included, ``n`` all words of the language, ``l`` and ``r`` the parts at the cut whose score
    floor(scale * a * n / (l * r)) is lowest (ties: the earlier cut). Phrases under ``min_count`` are no candidates;
    one that lies in a longer candidate with at least ``contained`` percent of its count is dropped. Equal scores go to the larger ``a``,
    then to the phrase that comes first in bytes.

    Defined cases: a null text is empty, a null language is ``und``; rows are counted as often as they occur; a text
    of any length is one row of word numbers; an empty table, and one without frequent phrases, has no result; other columns
    are not read. At most 2^(128 / max_words) words may be frequent (33 million for five), more are an error.
    """
    spark: SparkSession = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    rows = docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = stage(word_counts(rows), "phrases-counts")
    totals = stage(counts.groupBy("lang").agg(F.sum("n").alias("total")), "phrases-totals")
    words = numbered_words(counts, min_count)
    n_words, small = _enough(words)
    width = max(1, n_words.bit_length())
    if width * max_words > 128:
        raise ValueError(f"{n_words} frequent words are too many for phrases of {max_words}: raise min_count")
    if max_words < 2 or not n_words:
        return spark.createDataFrame([], _RESULT)
    encoded = stage((encoded_by_broadcast if small else encoded_by_join)(rows, words), "phrases-encoded")
    total = totals.agg(F.sum("total")).first()[0]
    range_bits = max(6, (total // RANGE_WORDS).bit_length())
    counted: list[DataFrame] = []
    frequent = None
    for k in range(2, max_words + 1):
        found = stage(phrase_counts(encoded, Codes(k, width), range_bits, min_count, frequent), f"phrases-{k}")
        if found.isEmpty():
            break
        counted.append(found)
        if k < max_words:
            frequent = _bitmap(found)
    if not counted:
        return spark.createDataFrame([], _RESULT)
    return scored(counted, words, totals, scale, contained, top)
