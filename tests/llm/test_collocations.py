"""Phrases against brute force, filters and codes against their definitions."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveymill.llm import collocations
from surveymill.llm.collocations import Codes, Filter


def brute(rows, min_count, max_words, top, contained=100):
    """rows: (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            own.update(tuple(words[i : i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        n, found = totals[lang], []
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        lost = {
            p[i : i + k] for p, longer in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * longer >= contained * own[p[i : i + k]]
        }
        for phrase, a in candidates.items():
            if phrase not in lost:
                score, _, left, right = min(
                    (1000 * a * n // (own[phrase[:k]] * own[phrase[k:]]), k, own[phrase[:k]], own[phrase[k:]]) for k in range(1, len(phrase))
                )
                found.append((-score, -a, " ".join(phrase).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def made_up(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a\x01b", "a", "é", "naïve", "x" * 300, "日本", "\x1f", "-"]
    fixed = ["new york city hall", "once upon a time there", "of the", "日本 a a a a"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(1, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", ";"]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), text))
    return [*rows, ("en", None), (None, None), ("en", ""), ("fr", " .. "), rows[0], rows[0], ("en", "new york city hall " * 3000)]


@pytest.mark.parametrize(("seed", "dictionary", "pending", "entries"), [(1, 10**6, 10**6, 10**6), (2, 0, 500, 700)])
def test_made_up_texts(spark, monkeypatch, seed, dictionary, pending, entries):
    monkeypatch.setattr(collocations, "DICTIONARY_WORDS", dictionary)
    monkeypatch.setattr(collocations, "PENDING", pending)
    monkeypatch.setattr(collocations, "FILTER_ENTRIES", entries)
    rows = made_up(seed)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    frame = frame.withColumns({"ids": F.lit(1), "n": F.lit("x"), "word": F.lit(None).cast("void"), "row": F.lit(2)})
    got = collocations.collocations(frame, min_count=5, top=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 5, 40)
    every = collocations.collocations(frame, min_count=2, max_words=3, top=10**6, contained=50)
    assert sorted(map(tuple, every.collect())) == brute(rows, 2, 3, 10**6, 50)


def test_none_and_empty(spark):
    frame = spark.createDataFrame([("en", "one two"), (None, None)], "lang string, text string")
    for rows in (frame, frame.limit(0)):
        got = collocations.collocations(rows)
        assert got.collect() == [] and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = collocations.collocations(frame, min_count=1)
    assert list(map(tuple, got.collect())) == [("en", 1, "one two", 1, 1, 1, 2, 2000)]


def test_too_many_words(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_enough", lambda words: (2**26, False))
    frame = spark.createDataFrame([("en", "one two")], "lang string, text string")
    with pytest.raises(ValueError, match="raise min_count"):
        collocations.collocations(frame, min_count=1)


@pytest.mark.parametrize("width", [1, 2, 7, 13, 24, 25])
@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_codes_are_permuted_and_restored(k, width):
    rng = np.random.default_rng(k * width)
    numbers = [rng.integers(0, 2**width, 500, dtype=np.uint64) for _ in range(k)]
    codes = Codes(k, width)
    high, low = codes.permute(*codes.pack(numbers))
    assert (high < 2**codes.half).all() and (low < 2**codes.half).all()
    assert (codes.unpack(*codes.restore(high, low)) == np.stack(numbers, axis=1)).all()
    assert len({*zip(high.tolist(), low.tolist(), strict=True)}) == len({*zip(*[c.tolist() for c in numbers], strict=True)})


@pytest.mark.parametrize("half", [1, 5, 20, 32, 33, 63])
@pytest.mark.parametrize("taken", [0, 1, 4])
def test_filters_come_back_and_merge(half, taken):
    taken = min(taken, half)
    rng = np.random.default_rng(half + taken)
    filters, expected = [], Counter()
    for size in (0, 1, 400, 3000):
        high, low = (rng.integers(0, 2**half, size, dtype=np.uint64) for _ in range(2))
        if size > 1:
            high[: size // 2] = high[0]  # a long run
        counts = rng.integers(1, 400, size)
        for h, lo, c in zip(high.tolist(), low.tolist(), counts.tolist(), strict=True):
            expected[h, lo] += c
        filters.append(Filter.of(half, high, low, counts))
    got = Counter()
    parts = {}
    for whole in filters:
        for number, part in whole.ranges(taken):
            parts.setdefault(number, []).append(Filter.from_bytes(part.to_bytes(taken), half, taken, number))
    for number, found in parts.items():
        merged = Filter.merged(found)
        keys = list(zip(merged.high.tolist(), merged.low.tolist(), strict=True))
        assert keys == sorted(set(keys)) and all(h >> (half - taken) == number for h, _ in keys)
        got.update(dict(zip(keys, merged.counts.tolist(), strict=True)))
    assert got == expected


def test_filters_are_compact():
    rng = np.random.default_rng(5)
    high, low = (rng.integers(0, 2**30, 100_000, dtype=np.uint64) for _ in range(2))
    whole = Filter.of(30, high, low, np.ones(100_000, np.int64))
    assert len(whole.to_bytes(0)) < 8 * len(whole)  # 60 bits of code and a counter in under 8 bytes
