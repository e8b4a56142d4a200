"""Sampled segmentations: lossless, reproducible, and drawn with the lattice's probabilities."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from surveymill.llm import sampling
from surveymill.llm.queries import op8_sampled_pieces

SF_DIR = "/root/testdata/sf0.01"
TEXTS = ["", " ", "  a  b ", "hello world", "▁ marks ▁▁", "日本 \U0001f642\n\nx\t\x00y", "long " * 20_000, "z" * 3000, "été\r\n", "�"]


def own():
    return sampling.sampler(sampling.public_model(), sampling.SHARPNESS)


def seeds(n, of=0):
    return sampling.mixed(np.arange(n, dtype=np.uint64) + np.uint64(of))


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text("ab ▁\n", max_size=50), max_size=5))
@settings(max_examples=200, deadline=None)
def test_decoding_is_lossless(texts):
    ids = own().sample(texts, seeds(len(texts)))
    assert [own().decode(x) for x in ids] == texts


def test_no_piece_crosses_a_unit():
    for piece in own().pieces:
        assert "\n" not in piece and (not piece.strip(" ") or " " not in piece.lstrip(" "))


def test_draws_do_not_depend_on_the_batch():
    s = seeds(len(TEXTS))
    together = own().sample(TEXTS, s)
    for i in reversed(range(len(TEXTS))):
        assert own().sample([TEXTS[i]], s[i : i + 1])[0].tolist() == together[i].tolist()
    other = sampling.Sampler(sampling.public_model())
    assert [x.tolist() for x in other.sample(TEXTS[::-1], s[::-1])] == [x.tolist() for x in together[::-1]]


def test_small_tables_start_anew(monkeypatch):
    monkeypatch.setattr(sampling, "KEPT_EDGES", 10)
    fresh = sampling.Sampler(sampling.public_model())
    for text in TEXTS[:6]:
        assert fresh.sample([text], seeds(1))[0].tolist() == own().sample([text], seeds(1))[0].tolist()


def all_ways(text, pieces):
    """Every segmentation of a text and its weight."""
    if not text:
        return [((), 1.0)]
    return [
        ((pieces[text[:n]][0], *rest), pieces[text[:n]][1] * weight)
        for n in range(1, len(text) + 1) if text[:n] in pieces
        for rest, weight in all_ways(text[n:], pieces)
    ]


def test_probabilities_are_those_of_all_segmentations():
    text, n = "the cat", 40_000
    ways = {}
    for a, wa in all_ways(" the", own().pieces):
        for b, wb in all_ways(" cat", own().pieces):
            ways[a + b] = wa * wb
    total = sum(ways.values())
    drawn = Counter(tuple(x.tolist()) for x in own().sample([text] * n, seeds(n, 77)))
    assert drawn.keys() <= ways.keys()
    for way, weight in ways.items():
        p = weight / total
        assert abs(drawn[way] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 2e-4


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "hello world"), (None, "x"), (4, None)]
    random.Random(6).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "seed": F.lit(2), "ids": F.lit("i")})
    got = sampling.sample_pieces(frame.repartition(3)).collect()
    assert sorted(((r.key, r.decoded) for r in got), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert len({tuple(r.ids) for r in got if r.key == 3}) == 1
    again = sampling.sample_pieces(frame.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    other = sampling.sample_pieces(frame, seed=1).collect()
    assert sorted(map(repr, other)) != sorted(map(repr, got))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sampling.sample_pieces(empty).collect() == []


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("c"))
    got = op8_sampled_pieces(spark, SF_DIR).select("doc_id", F.col("decoded_crc32").alias("c"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    model = SentencePieceProcessor(model_file=sampling.public_model())
    for r in sampling.sample_pieces(docs.limit(20)).collect():
        assert model.decode(list(r.ids)) == r.decoded


def test_passes_side_by_side_and_in_turn_draw_the_same(monkeypatch):
    rng = random.Random(12)
    texts = ["hello world the quick", "", "日本語テキスト" * 5, "naïve\n\n  x", "a" * 300, "nul \0 byte", "\0", "🙂é퟿"]
    texts += ["".join(rng.choices("the of and ing 日é\n", k=80)) for _ in range(60)]
    seeds = np.arange(len(texts)).astype(np.uint64) * np.uint64(7919)
    drawn = []
    for side_by_side, few in ((1, 1), (10**9, 1), (50, 16), (1, 10**9)):
        monkeypatch.setattr(sampling, "SIDE_BY_SIDE", side_by_side)
        monkeypatch.setattr(sampling, "FEW", few)
        own = sampling.Sampler(sampling.public_model())
        drawn.append([ids.tolist() for ids in own.sample(texts, seeds)])
        assert [own.decode(np.array(ids)) for ids in drawn[-1]] == texts
    assert all(one == drawn[0] for one in drawn)


def test_long_units_and_scripts_without_blanks():
    """Work grows with the characters: these took minutes when units were walked one character at a time."""
    rng = random.Random(13)
    own = sampling.Sampler(sampling.public_model())
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    lines = "\n".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(rng.randrange(150, 450))) for _ in range(1100))
    start = time.process_time()
    for text in (letters, lines):
        (ids,) = own.sample([text], np.array([3], np.uint64))
        assert own.decode(ids) == text
    assert time.process_time() - start < 20


def test_ids_of_a_whole_table(spark):
    """The query's hashes against samples drawn in one process, a text at a time."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.xxhash64(F.lit(0), "doc_id").alias("seed")).collect()
    own = sampling.Sampler(sampling.public_model())
    drawn = [(d.doc_id, own.sample([d.text or ""], np.array([d.seed], np.int64).view(np.uint64))[0].tolist()) for d in docs]
    expected = spark.createDataFrame(drawn, "doc_id long, ids array<int>").select("doc_id", F.size("ids").cast("long"), F.xxhash64("ids"))
    got = op8_sampled_pieces(spark, folder).select("doc_id", "n_pieces", "ids_hash")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
