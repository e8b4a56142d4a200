"""Site-relative line frequency against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveymill.llm import boilerplate


def lower(n, pages, deviations):
    """The lower end of the score interval: the least share s with n / pages - s <= deviations * sqrt(s (1 - s) / pages)."""
    low, high = 0.0, n / pages
    for _ in range(200):
        s = (low + high) / 2
        low, high = (s, high) if n / pages - s > deviations * math.sqrt(s * (1 - s) / pages) else (low, s)
    return high


def brute(rows, ratio, deviations=boilerplate.DEVIATIONS):
    totals = Counter(h for h, _ in rows)
    counts = Counter((h, line) for h, t in rows if h is not None and t is not None for line in set(t.split("\n")) if line.strip(" "))
    out = []
    for h, t in rows:
        if h is not None and t is not None:
            t = "\n".join(x for x in t.split("\n") if not x.strip(" ") or lower(counts[h, x], totals[h], deviations) <= ratio)
        out.append((h, t))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_random_pages(spark, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(8)
    rows = []
    for host, pages in (("hot", 300), ("b", 40), ("", 20), ("tiny", 4), (None, 30)):
        for _ in range(pages):
            lines = [rng.choice(["menu", "login", " ", "", "Copyright", "a\tb", "é"]) for _ in range(rng.randrange(0, 6))]
            lines += [f"unique {rng.random()}" for _ in range(rng.randrange(0, 4))]
            rng.shuffle(lines)
            rows.append((host, "\n".join(lines)))
    rows += [("hot", None), ("b", "menu\n" * 3000), ("b", "one very long line " * 20_000), ("tiny", "menu"), ("hot", rows[0][1])]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "source string, text string").repartition(6)
    names = {"lines": F.lit(1), "known_host": F.lit("k"), "hash": F.lit(2), "c0": F.lit(3), "host": F.lit("h")}
    frame = frame.withColumns(names)
    for ratio, deviations in ((0.1, 3.0), (0.5, 1.0), (0.1, 0.0)):
        got = boilerplate.drop_boilerplate(frame, ratio=ratio, deviations=deviations)
        assert got.columns == frame.columns
        assert sorted(((r.source, r.text) for r in got.collect()), key=repr) == brute(rows, ratio, deviations)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "source string, text string")
    assert boilerplate.drop_boilerplate(empty).collect() == []


def test_a_single_page_keeps_its_lines_and_certainty_grows_with_pages(spark):
    rows = [("one", "a\nb")] + [(f"h{n}", f"menu\nown {i}") for n in (2, 3, 8, 40) for i in range(n)]
    got = boilerplate.drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).collect()
    assert sorted((r.source, r.text) for r in got) == brute(rows, 0.1)
    assert ("one", "a\nb") in [(r.source, r.text) for r in got] and all("menu" not in r.text for r in got if r.source != "one")
