"""The rule ledger against brute force, policies and ablations."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveymill.llm import quality


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_letters": len(re.findall("[A-Za-z]", text)),
    }


@given(st.text("ab \n#A", max_size=120) | st.lists(st.sampled_from("ab"), max_size=60).map(" ".join))
@settings(max_examples=300, deadline=None)
def test_measure(text):
    assert quality.measure(text) == brute(text)


GOOD = "A plain sentence about nothing much, long enough to be kept by every rule there is."


def _frame(spark):
    rows = [
        (1, GOOD), (2, None), (3, ""), (4, " \n "), (5, "one two"), (6, "x y z v w " * 9), (7, GOOD), (7, GOOD),
        (None, GOOD), (8, GOOD + " ###" * 9), (9, "\n".join(["same line again"] * 8 + [GOOD] * 2)), (10, GOOD.upper()),
        (11, "lang " * 100_000), (12, " ".join(map(str, range(100_000)))), (13, "w" * 50 + " " + "v" * 5000 + " a b c d e f g h i"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, frame.withColumns({"failed": F.lit("f"), "n_words": F.lit(-1), "c0": F.lit(0), "_text": F.lit("t")})


def test_ledger_and_policies(spark):
    rows, frame = _frame(spark)
    entries = quality.judge(quality.ledger(frame), [quality.BASE, quality.POLICY])
    got = entries.collect()
    assert len(got) == len(rows)
    names = [name for name, _ in quality.RULES]
    for row, (doc_id, text) in zip(got, rows, strict=True):
        text = text or ""
        if len(text) < 10_000:
            assert {k: row[k] for k in quality.MEASURES} == brute(text)
        n = row.n_words
        failed = {
            "few_words": n < 10,
            "repeated_words": 100 * row.n_repeat_words > 20 * n,
            "symbols": 5 * row.n_symbols > n,
            "duplicate_lines": row.n_lines >= 6 and 2 * row.n_dup_lines > row.n_lines,
            "word_length": row.word_chars > 40 * n,
            "upper_case": row.n_letters >= 40 and 5 * row.n_upper > 4 * row.n_letters,
        }
        assert row.doc_id == doc_id and row.failed == sum(1 << names.index(k) for k, v in failed.items() if v)
        assert row.kept_base == (not (failed["few_words"] or failed["repeated_words"]))
        assert row.kept_2 == (not any(failed.values()))
    kept = quality.keep_good(frame)
    assert kept.columns == frame.columns
    assert [(r.doc_id, r.text) for r in kept.collect()] == [x for x, r in zip(rows, got, strict=True) if r.kept_2]
    assert [i for i in (1, 7, None, 12) if i not in {r.doc_id for r in kept.collect()}] == []


def test_ablations(spark):
    masks = [0, 0, 1, 2, 3, 4, 6, 6, 5]
    entries = spark.createDataFrame([(m,) for m in masks], "failed long")
    policy = quality.Policy("t", ("few_words", "repeated_words"))
    got = {r.rule: r.asDict() for r in quality.ablations(entries, policy).collect()}
    for bit, rule in enumerate(policy.rules):
        other = 3 & ~(1 << bit)
        assert got[rule] == {
            "rule": rule,
            "fails": sum(m >> bit & 1 for m in masks),
            "rejects_alone": sum(m & 3 == 1 << bit for m in masks),
            "kept_without": sum(m & other == 0 for m in masks),
            "kept": sum(m & 3 == 0 for m in masks),
        }


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.ledger(empty).collect() == quality.keep_good(empty).collect() == []
    assert quality.ablations(quality.ledger(empty)).collect() == []
