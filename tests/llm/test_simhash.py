"""SimHash near-duplicates against brute force on random texts and random fingerprints."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from surveymill.llm import simhash
from surveymill.llm.common import stage
from surveymill.llm.queries import QUERIES


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(fps, budget):
    """fps: {row: (id, fp)}; the smallest id reachable from every row."""
    rows = list(fps)
    root = {r: r for r in rows}

    def find(r):
        while root[r] != r:
            r = root[r]
        return r

    for i, a in enumerate(rows):
        for b in rows[:i]:
            if (fps[a][1] ^ fps[b][1]).bit_count() <= budget:
                root[find(a)] = find(b)
    least = {}
    for r in rows:
        if fps[r][0] is not None:
            least[find(r)] = min(least.get(find(r), fps[r][0]), fps[r][0])
    return {r: least.get(find(r)) for r in rows}


def test_fingerprint_is_the_definition():
    rng = random.Random(3)
    texts = ["", " \t\n", "One", "one TWO", "Ünï CÖDE ß word", "a b c a b c a b c", "x\x0by\x0cz w"]
    texts += [" ".join(rng.choices(["a", "b", "cc", "D", "é"], k=rng.randrange(1, 200))) for _ in range(30)]
    for text in texts:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("node_limit", [50_000, 3])
@pytest.mark.parametrize("budget", [3, 1])
def test_links_of_random_fingerprints(spark, node_limit, budget):
    rng = random.Random(node_limit + budget)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    fps = set(seeds) | {0, 2**64 - 1}
    for seed in seeds:
        for _ in range(12):
            fps.add(seed ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(0, 5))))
    # a group that shares its upper half, so that one subtree of a trie is large
    fps |= {(seeds[0] >> 32 << 32) | rng.getrandbits(32) for _ in range(60)}
    rows = {i: (i, fp) for i, fp in enumerate(sorted(fps))}
    classes = spark.createDataFrame(
        [(int(np.uint64(fp).view(np.int64)), i) for i, fp in rows.values()], "fp long, id long"
    )
    links = simhash.trie_links(classes, budget, node_limit)
    for link in links.collect():
        assert link.fp_a != link.fp_b
    found = simhash.components(links.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")))
    roots = {r.node: r.root for r in found.collect()}
    expected = brute_components(rows, budget)
    assert {i: roots.get(i, i) for i in rows} == expected


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame(path + star + [(7, 7)], "u long, v long")
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert roots == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_documents(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choices("abcdefghijklmnop", k=400)) for _ in range(5)]
    texts = [None, "", "  ", "solo", "solo", "long " * 20000]
    for text in base:
        texts.append(text)
        for _ in range(4):
            words = text.split()
            words[rng.randrange(400)] = "changed"
            texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "solo"), (None, base[0]), (None, "nobody else"), (9, "other text")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit("x"), "id": F.lit(0), "component": F.lit(1), "tree": F.lit(None).cast("void")}
    )
    got = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=repr)
    fps = {k: (i, brute_fingerprint(t or "")) for k, (i, t) in enumerate(rows)}
    component = brute_components(fps, 3)
    signed = lambda fp: int(np.uint64(fp).view(np.int64))
    assert got == sorted([(i, signed(fp), component[k]) for k, (i, fp) in fps.items()], key=repr)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(frame).collect() == []


@pytest.mark.parametrize("frontier", [simhash.FRONTIER, 7])
def test_walk_in_parts_of_the_frontier(monkeypatch, frontier):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    rng = random.Random(frontier)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({s ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(0, 4))) for s in seeds for _ in range(30)})
    starts = np.array([[0], [len(fps)], [0], [len(fps)], [0]])
    found = {
        (min(a, b), max(a, b))
        for x, y in simhash.walk(np.array(fps, np.uint64), starts, 64, 3)
        for a, b in zip(x.tolist(), y.tolist(), strict=True)
    }
    assert found == {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 3}


@pytest.mark.parametrize(("spread", "base"), [(range(20), 0x123456789ABCDEF0), (range(30, 50), 2**64 - 1), (range(0, 64, 3), 0)])
def test_no_unit_is_over_the_limit(spark, spread, base):
    """A large family of near copies whose differences lie in few bits, so that its fingerprints share long paths."""
    rng = random.Random(len(spread))
    fps = {base ^ sum(1 << b for b in rng.sample(list(spread), rng.randrange(0, 6))) for _ in range(2500)} | {rng.getrandbits(64) for _ in range(50)}
    rows = {i: (i, fp) for i, fp in enumerate(sorted(fps))}
    classes = spark.createDataFrame([(int(np.uint64(fp).view(np.int64)), i) for i, fp in rows.values()], "fp long, id long")
    limit = 300
    units = stage(simhash.trie_units(classes, 3, limit), "test-units")
    sizes = units.groupBy("tree", "top", "a", "b", "split").agg(F.count("*").alias("n")).collect()
    assert max(r.n for r in sizes) <= limit and max(r.split for r in sizes) > 0
    found = simhash.components(simhash.trie_links(classes, 3, limit).select(F.col("id_a").alias("u"), F.col("id_b").alias("v")))
    roots = {r.node: r.root for r in found.collect()}
    assert {i: roots.get(i, i) for i in rows} == brute_components(rows, 3)


def test_the_whole_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {k: (r.doc_id, brute_fingerprint(r.text or "")) for k, r in enumerate(docs.collect())}
    component = brute_components(rows, 3)
    expected = sorted((i, f"{fp:016x}", component[k]) for k, (i, fp) in rows.items())
    assert sorted(map(tuple, QUERIES["op3_simhash_trie_join"](spark, "/root/testdata/sf0.001").collect())) == expected
