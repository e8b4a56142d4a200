"""Token ids, Simple-8b and packing against the library, exact round trips and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveymill.llm import packing, simple8b, tokens
from surveymill.llm.queries import op1_simple8b_token_files, op4_differencing_packing
from surveymill.llm.tokens import encoder, public_file

SF_DIR = "/root/testdata/sf0.01"
TEXTS = [
    None, "", " ", "  ", "a", "a  b   c", "don't we'll 'tis '' '", "x\n\ny\n z \n", "\n", "tab\there", "ünïcode Straße ½ ²",
    "日本語 テスト", "émoji 🙂 done", "<|endoftext|>", "a <|endoftext|> b", "1234 a1b2", "word " * 3000, "x" * 5000,
    " nb sp ", "!!! ??--..", "a_b __c__ `d`",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_file())
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@given(st.text(st.characters(exclude_categories=["Cs"])))
@settings(max_examples=300, deadline=None)
def test_encoder_on_any_text(text):
    own = encoder(public_file())
    expected = own._tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == expected


@given(st.text("ab'st \n.,!0é_  ", max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoder_on_plain_texts(text):
    own = encoder(public_file())
    expected = own._tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == expected


ids = st.integers(0, 50256) | st.integers(0, 3) | st.integers(0, 2**64 - 1)


@given(st.lists(st.lists(ids, max_size=90) | st.lists(st.integers(0, 1), max_size=400), max_size=6))
@settings(max_examples=300, deadline=None)
def test_simple8b_round_trip(lists):
    coded = simple8b.encode([np.array(x, np.uint64) for x in lists])
    decoded = simple8b.decode([(*c, len(x)) for c, x in zip(coded, lists, strict=True)])
    assert [x.tolist() for x in decoded] == lists


def test_simple8b_blocks_and_escapes():
    rng = random.Random(5)
    values = [rng.choice([0, 1, 7, 300, 50256, 2**60, 2**64 - 1, 15 << 60]) for _ in range(5 * simple8b.BLOCK + 17)]
    ((offsets, words),) = simple8b.encode([np.array(values, np.uint64)])
    assert len(offsets) == 6 and offsets[0] == 0
    assert simple8b.decode([(offsets, words, len(values))])[0].tolist() == values
    ones = np.ones(simple8b.BLOCK, np.uint64)
    assert len(simple8b.encode([ones])[0][1]) == -(-simple8b.BLOCK // 60)


def _frame(spark):
    rows = [(i * 3 % 41, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again"), (5, "again")]
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, frame.withColumns({"id": F.lit(1), "place": F.lit("x"), "part": F.lit(None).cast("int")})


def test_token_files(spark, library):
    rows, frame = _frame(spark)
    read = simple8b.token_files(frame).orderBy("start").collect()
    ids = [r.doc_id for r in read]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for r in read:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    expected = sorted((repr(i), np.array([*library(t or ""), 0], "<u4").tobytes()) for i, t in rows)
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in read) == expected


def test_token_files_of_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simple8b.token_files(empty).collect() == []
    assert packing.pack(empty).collect() == []


def _by_library(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return {r.doc_id: np.array([*library(r.text or ""), 0], "<u4") for r in docs}


def test_op1_on_the_whole_table(spark, library):
    expected, at = [], 0
    for doc_id, ids in _by_library(spark, library).items():
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, op1_simple8b_token_files(spark, SF_DIR).collect())) == expected


def check_packing(pieces, ids_of, capacity):
    """Every id in one piece, no gaps, no window over its capacity; returns windows and ids."""
    docs, windows = {}, {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert docs.keys() == ids_of.keys()
    for doc_id, parts in docs.items():
        at = 0
        for start, length, crc, total in sorted(parts):
            assert start == at and length > 0 and total == len(ids_of[doc_id])
            assert crc == zlib.crc32(ids_of[doc_id][start : start + length].tobytes())
            at += length
        assert at == len(ids_of[doc_id])
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows), sum(map(len, ids_of.values()))


def test_op4_on_the_whole_table(spark, library):
    ids_of = _by_library(spark, library)
    windows, total = check_packing(op4_differencing_packing(spark, SF_DIR).collect(), ids_of, 1024)
    assert windows * 1024 < 1.03 * total


@pytest.mark.parametrize("capacity", [1, 2, 64])
def test_packing_of_odd_texts(spark, library, capacity):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sequence_id", F.lit(0))
    pieces = packing.pack(frame, capacity=capacity, windows=3)
    made = pieces.withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(made, {i: np.array([*library(t or ""), 0], "<u4") for i, t in rows}, capacity)
    for s in packing.sequences(pieces, capacity).collect():
        whole = s.length & (s.length - 1) == 0
        assert len(s.ids) == 4 * (s.length if whole else capacity)
        own = sorted((p for p in made if p.sequence_id == s.sequence_id), key=lambda p: p.offset)
        assert bytes(s.ids)[: 4 * s.length] == b"".join(bytes(p.ids) for p in own)


def test_pieces_with_repeated_and_missing_ids(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    made = packing.pack(frame).collect()
    assert sorted((p.doc_id or 0, p.length) for p in made) == [(0, 2), (1, 3), (1, 3)]


@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 90))
@settings(max_examples=100, deadline=None)
def test_fill(sizes, capacity):
    windows = packing.fill(sizes, capacity)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= capacity for w in windows)


def test_differencing_balances():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 256) for _ in range(300)]
    sums = [sum(sizes[i] for i in w) for w in packing.difference(sizes, 32)]
    assert len(sums) == 32 and max(sums) - min(sums) < 30


@pytest.mark.parametrize("together", [1, 3, 1000])
def test_a_small_store_forgets_and_learns_again(monkeypatch, together):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 40)
    monkeypatch.setattr(tokens, "PIECES_TOGETHER", together)
    own = tokens.Encoder(tokens.public_file())
    rng = random.Random(together)
    words = ["the", "Über", "naïve", "x1", "'s", "--", "\n\n", "  ", "élan", "don't", "<|endoftext|>", *("".join(rng.choices("abcdeé", k=7)) for _ in range(300))]
    for _ in range(60):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 40)))
        expected = own._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == expected
        assert len(own._pieces.young) <= 40 + 200


def test_differencing_deals_as_merging_lists_does():
    """Windows read back from the merges are those that carrying every window's pieces through each merge gives."""

    def plain(sizes, windows):
        heap = [(-size, n, [(size, [n]), *[(0, [])] * (windows - 1)]) for n, size in enumerate(sizes)]
        for turn in range(len(sizes), 2 * len(sizes) - 1):
            heap.sort(key=lambda part: part[:2])
            (_, _, a), (_, _, b), *heap = heap
            merged = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, reversed(b))), key=lambda w: -w[0])
            merged = [(size - merged[-1][0], pieces) for size, pieces in merged]
            heap.append((-merged[0][0], turn, merged))
        return [sorted(pieces) for _, pieces in heap[0][2] if pieces] if heap else []

    rng = random.Random(7)
    for _ in range(60):
        sizes = [rng.randint(1, rng.choice([3, 256])) for _ in range(rng.choice([0, 1, 2, 9, 60]))]
        windows = rng.choice([1, 2, 5, 64])
        assert [sorted(window) for window in packing.difference(sizes, windows)] == plain(sizes, windows)
