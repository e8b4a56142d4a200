"""Harmonisation: raw edition columns onto the canonical input fields, all editions in one projection.

The mapping is a table: for each edition the place of every field among its columns. It is joined to the rows by year, and
a field is the cell at its place. So the plan is the same for three editions and for three thousand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.functions.text import null_tokens
from surveymill.operators.headers import RESOLVED_FIELDS
from surveymill.operators.respondents import contract
from surveymill.sources.lake import small
from surveymill.sources.survey_csv import Editions


def places(mapping: DataFrame, used: list[int]) -> DataFrame:
    """``(survey_year, places)``: for each field in order its place from 1 among the columns ``used``, null where it has none."""
    of_fields = [F.max(F.when(F.col("field") == field, F.col("pos"))).alias(field) for field in RESOLVED_FIELDS]
    known = f"array({', '.join(map(str, used))})" if used else "CAST(array() AS ARRAY<INT>)"
    found = ", ".join(f"nullif(array_position({known}, {field}), 0L)" for field in RESOLVED_FIELDS)
    return mapping.groupBy("survey_year").agg(*of_fields).selectExpr("survey_year", f"transform(array({found}), p -> CAST(p AS INT)) AS places")


def harmonise(editions: Editions, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of all editions with the canonical input schema. Only columns that some edition maps are read.

    mapping: ``(survey_year, field, source_header, pos)``; registry: ``(survey_year, edition)``, of the editions that are kept.
    """
    used = sorted(row["pos"] for row in mapping.filter("pos IS NOT NULL").select("pos").distinct().collect())  # columns of the widest edition at most
    table = small(places(mapping, used).join(registry, "survey_year"))
    cells = F.array(*[F.col(f"c{pos}") for pos in used]) if used else F.expr("CAST(array() AS ARRAY<STRING>)")
    rows = editions.rows.select("survey_year", cells.alias("cells")).join(table, "survey_year")
    answers = [f"try_element_at(cells, places[{n}]) AS {field}" for n, field in enumerate(RESOLVED_FIELDS)]
    raw = rows.selectExpr("survey_year", "edition", *answers)
    return contract(raw, {"survey_year": "survey_year", "edition": "edition", **{field: null_tokens(field) for field in RESOLVED_FIELDS}})
