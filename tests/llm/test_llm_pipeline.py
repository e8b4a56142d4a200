"""The stages one after the other, each against a plain version of itself on its own input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from surveymill.llm import quality, secrets, simhash
from surveymill.llm.common import stage
from surveymill.llm.tokens import encoder, public_file
from test_boilerplate import brute as brute_lines
from test_simhash import brute_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = [(None, "No id but a text that is long enough to pass the rules of quality here.", "en", "src1", 5)] * 2
    extra += [(7, docs.filter("doc_id = 7").first().text, "en", None, 5), (900, None, None, None, None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("component_id", F.lit("clash"))
    tables = [docs]
    for name, work in corpus_pipeline.STAGES:
        tables.append(stage(work(spark, tables[-1], SF_DIR), f"test-{name}"))
    return tables


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_columns(results):
    for frame in results[1:-1]:
        assert frame.columns == results[0].columns


def test_quality_stage(results):
    entries = quality.ledger(results[0]).collect()
    expected = [d for d, e in zip(rows(results[0]), entries, strict=True) if e.failed == 0]
    assert sorted(map(repr, rows(results[1]))) == sorted(map(repr, expected))


def test_line_stage(results):
    before, after = rows(results[1]), rows(results[2])
    expected = brute_lines([(d["source"], d["text"]) for d in before], 0.1)
    assert sorted(((d["source"], d["text"]) for d in after), key=repr) == expected
    assert all(d["n_chars"] == len(d["text"]) for d in after)


def test_near_duplicate_stage(results):
    before, after = rows(results[2]), rows(results[3])
    assert sorted(map(repr, after)) == sorted(map(repr, first_of_each(before)))


def first_of_each(before):
    """By brute force: of each component the row of the smallest id, fingerprint; rows that tie in both must be equal."""
    fps = {k: (k, simhash.fingerprint(d["text"] or "")) for k, d in enumerate(before)}
    component, best = brute_components(fps, 3), {}
    for k, d in enumerate(before):
        rank = (d["doc_id"] is None, d["doc_id"] or 0, int(np.uint64(fps[k][1]).view(np.int64)))
        if component[k] not in best or rank < best[component[k]][0]:
            best[component[k]] = (rank, d)
    return [d for _, d in best.values()]


def test_near_duplicates_of_clashing_columns_and_without_id(spark):
    one, two, three = ("alpha beta gamma delta " * 20, "some quite other words " * 20, "third text of its own kind " * 20)
    given = [(None, one), (None, one), (None, two), (5, one), (None, three), (None, three), (None, None), (8, two), (8, two), (9, three + "more"), (2**40, "x y z")]
    names = ["_fp", "row_hash", "fp", "doc_id_", "component_id", "root_fp", "first_id", "c0", "hash", "again", "n"]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    docs = docs.withColumns({n: F.lit(i) for i, n in enumerate(names)}).withColumn("tags", F.create_map(F.lit("k"), F.lit(1)))
    before = [r.asDict() for r in docs.collect()]
    got = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted(repr(r.asDict()) for r in got.collect()) == sorted(map(repr, first_of_each(before)))
    assert {(r["doc_id"], r["text"]) for r in first_of_each(before)} >= {(5, one), (8, two), (2**40, "x y z")}


def test_near_duplicates_that_repeat_an_id(spark):
    one, two, three = ("alpha beta gamma delta " * 20, "some quite other words " * 20, "third text of its own kind " * 20)
    given = [(1, one), (1, two), (2, one), (3, two), (5, three), (6, three), (6, one), (6, "a document of its own with the id of two copies"), (9, one), (9, one)]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    fps = {k: (i, simhash.fingerprint(t)) for k, (i, t) in enumerate(given)}
    assert all((a[1] ^ b[1]).bit_count() in (0, *range(4, 65)) for a in fps.values() for b in fps.values())
    kept = sorted(tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect())
    assert kept == sorted([(1, one), (1, two), (5, three), given[7]])


def test_secret_stage(results):
    before, after = rows(results[3]), rows(results[4])
    assert len(before) == len(after)
    cleaned = {d["doc_id"]: d for d in after}
    for d in before:
        base = secrets.scan(d["text"])[0]
        if d["doc_id"] is not None and base:
            assert "[SECRET]" in cleaned[d["doc_id"]]["text"] and not secrets.scan(cleaned[d["doc_id"]]["text"])[0]


def test_packing_stage(results):
    expected = sum(len(encoder(public_file()).encode(d["text"])) // 4 + 1 for d in rows(results[4]))
    assert results[5].agg(F.sum("length")).first()[0] == expected


def test_run_is_the_stages(spark):
    docs = corpus_pipeline.run(spark, SF_DIR)
    assert docs.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert docs.count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, SF_DIR)
    assert docs.collect() == []
