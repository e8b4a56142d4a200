"""A training corpus from the documents table: filtered, cleaned, deduplicated, scanned for secrets and packed.

Each stage takes all rows that its predecessor kept. All but the last return the columns of documents; a
stage that changes texts brings ``n_chars`` up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.llm import boilerplate, packing, quality, secrets, simhash
from surveymill.llm.common import stage, table


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go; one without text has no words and fails. Rows are judged each, whatever their
    id; an empty table stays empty; all columns are carried along (see ``quality.keep_good``)."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; documents stay, also those without text or source. ``n_chars`` follows the
    text where there is such a column (see ``boilerplate.drop_boilerplate``)."""
    return _counted(boilerplate.drop_boilerplate(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that fingerprint links connect, one stays: the one with the smallest id. Documents without id come
    last, rows that repeat an id are told apart by their text; nulls and clashing names as in ``simhash.keep_one_of_each``."""
    return simhash.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; documents stay, a null text stays null. ``n_chars`` follows the text where there is
    such a column (see ``secrets.redact``)."""
    return _counted(secrets.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in windows of equal capacity, a row for each piece; a document without text is its end id alone, an
    empty table has no pieces, other columns are not read (see ``packing.pack``)."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

#: No SQL: the stages hash, test and pack in ways SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
