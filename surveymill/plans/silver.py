"""Bronze to silver: one distributed plan from the raw editions to the respondent table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from surveymill.fixed_values import EDITIONS
from surveymill.operators.harmonise import harmonise
from surveymill.operators.headers import resolve_schema
from surveymill.operators.respondents import enrich, violations
from surveymill.sources.editions import edition_path, registry
from surveymill.sources.lake import read_silver, small, write_silver
from surveymill.sources.landing import read_landed_editions
from surveymill.sources.survey_csv import Editions, scan_editions


def open_editions(
    spark: SparkSession, bronze: str, editions: Mapping[int, str] = EDITIONS, landed: bool = False, rejects: bool = False
) -> Editions:
    """The registered editions of a bronze layer, as CSV files or as landed Parquet copies."""
    if landed:
        return read_landed_editions(spark, bronze, list(editions))
    return scan_editions(spark, {year: edition_path(bronze, year) for year in editions}, rejects=rejects)


def mapping(opened: Editions) -> DataFrame:
    """``(survey_year, field, source_header, pos)`` for every canonical field of the editions."""
    return resolve_schema(opened.catalog)


def mapping_report(spark: SparkSession, opened: Editions, editions: Mapping[int, str] = EDITIONS) -> DataFrame:
    """The mapping with edition names, for people."""
    named = mapping(opened).join(small(registry(spark, editions)), "survey_year")
    return named.select("survey_year", "edition", "field", "source_header")


def harmonised(spark: SparkSession, opened: Editions, editions: Mapping[int, str] = EDITIONS) -> DataFrame:
    """All editions on the canonical input schema."""
    return harmonise(opened, mapping(opened), registry(spark, editions))


def build_silver(
    spark: SparkSession,
    bronze: str,
    target: str,
    editions: Mapping[int, str] = EDITIONS,
    landed: bool = False,
    rejects: str | None = None,
    observed: Observation | None = None,
) -> DataFrame:
    """Write the respondent table and return it as read back.

    ``rejects`` is where records that are no rows are written ``(survey_year, file, record, reason)``; without it one stops
    the build. ``observed`` gets the counts of contract violations, taken from the rows as they are written.
    """
    opened = open_editions(spark, bronze, editions, landed, rejects is not None)
    silver = enrich(harmonised(spark, opened, editions))
    if observed is not None:
        silver = silver.observe(observed, *violations())
    write_silver(silver, target)
    if opened.rejects is not None:
        opened.rejects.write.mode("overwrite").parquet(rejects)
    return read_silver(spark, target)
