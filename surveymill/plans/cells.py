"""Respondent cells: the mergeable form every gold table is computed from.

``units`` turns each respondent into a cell of size one: the category columns plus counts and
sums. Cells can be added up along any categories and the result is again a set of cells. A gold
table is therefore the same code on raw respondents (one scan, one shuffle of map-side combined
groups) and on cells that were added up before, so that a build of all tables scans the
respondents once per cell set instead of once per table.

Midpoints are multiples of 500 and flags are 0/1, so the sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.fixed_values import REMOTE, SENIOR, TOOLS, WOMEN
from surveymill.functions.text import literal

ROLE_KEYS = ("survey_year", "is_employed", "gender_group", "job_family", "seniority_group")
EDITION_KEYS = ("survey_year", "edition", "is_employed", "answered_tools")
PLACE_KEYS = ("survey_year", "is_employed", "region_group", "work_model_group")
SECTOR_KEYS = ("survey_year", "is_employed", "sector")

_SALARY = ("salary_n", "salary_sum")
ROLE_MEASURES = ("n", *_SALARY, "seniors", "genai_n", "genai_sum", "genai_salary_n", "genai_salary_sum")
EDITION_MEASURES = ("n", *_SALARY, "women", "remote", "genai_n", "genai_sum") + tuple(
    f"{tool}_{part}" for tool in TOOLS for part in ("n", "sum")
)
PLACE_MEASURES = ("n", *_SALARY)


def _one_if(condition: str) -> str:
    return f"IF({condition}, 1L, 0L)"


_UNITS = {
    "n": "1L",
    "salary_n": _one_if("salary_midpoint IS NOT NULL"),
    "salary_sum": "salary_midpoint",
    "women": _one_if(f"gender_group = {literal(WOMEN)}"),
    "remote": _one_if(f"work_model_group = {literal(REMOTE)}"),
    "seniors": _one_if(f"seniority_group = {literal(SENIOR)}"),
    "genai_n": _one_if("uses_genai IS NOT NULL"),
    "genai_sum": "CAST(uses_genai AS BIGINT)",
    "genai_salary_n": _one_if("uses_genai IS NOT NULL AND salary_midpoint IS NOT NULL"),
    "genai_salary_sum": "IF(uses_genai IS NOT NULL, salary_midpoint, NULL)",
    "answered_tools": "uses_python IS NOT NULL OR uses_sql IS NOT NULL",
    **{f"{tool}_n": _one_if(f"{tool} IS NOT NULL") for tool in TOOLS},
    **{f"{tool}_sum": f"CAST({tool} AS BIGINT)" for tool in TOOLS},
}


def units(silver: DataFrame) -> DataFrame:
    """One cell per respondent; a projection, pruned to what the table at hand uses."""
    return silver.selectExpr("*", *[f"{measure} AS {name}" for name, measure in _UNITS.items()])


def add_up(cells: DataFrame, keys, measures) -> DataFrame:
    """Cells of coarser categories."""
    return cells.groupBy(*keys).agg(*[F.sum(measure).alias(measure) for measure in measures])
