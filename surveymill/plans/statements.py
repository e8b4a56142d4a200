"""The analyses as SQL statements on the gold tables, for users who ask in SQL.

Each statement names one gold table and, where it is about one year, the parameter ``:year``. Nulls sort as
Spark sorts them: first in ascending, last in descending order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from surveymill.fixed_values import (
    FOCUS_REGION,
    LADDER_FAMILIES,
    LADDER_LEVELS,
    MEN,
    SENIOR,
    STAFF_LEVEL,
    TOP_SECTORS,
    TREND_FAMILIES,
    TREND_TOOLS,
    WOMEN,
)
from surveymill.functions.text import literal, literals
from surveymill.plans.analyses import LATEST
from surveymill.sources.lake import register_views


def _side(column: str, group: str, name: str) -> str:
    return f"max({column}) FILTER (WHERE gender_group = {literal(group)}) AS {name}"


def _total(by: str) -> str:
    return f"SELECT {by}, sum(n) AS n FROM region_work_model WHERE survey_year = :year GROUP BY {by} ORDER BY n DESC"


STATEMENTS = {
    "q_overview": "SELECT * FROM overview ORDER BY survey_year",
    "q_market_2025": "SELECT * FROM market_structure WHERE survey_year = :year ORDER BY professionals DESC",
    "q_market_trend": f"""SELECT survey_year, job_family, share_pct FROM market_structure
        WHERE job_family IN ({literals(TREND_FAMILIES)}) ORDER BY job_family, survey_year""",
    "q_salary_senior": f"""SELECT job_family, avg_salary, n FROM salary_role_seniority
        WHERE survey_year = :year AND seniority_group = {literal(SENIOR)} ORDER BY avg_salary DESC""",
    "q_salary_ladder": f"""SELECT job_family, seniority_group, n, avg_salary FROM salary_role_seniority
        WHERE survey_year = :year AND job_family IN ({literals(LADDER_FAMILIES)})
          AND seniority_group IN ({literals(LADDER_LEVELS)}) ORDER BY job_family, seniority_group""",
    "q_salary_staff": f"""SELECT job_family, n, avg_salary FROM salary_role_seniority
        WHERE survey_year = :year AND seniority_group = {literal(STAFF_LEVEL)} ORDER BY avg_salary DESC""",
    "q_gender": "SELECT * FROM gender_gap ORDER BY survey_year, gender_group",
    "q_gender_pivot": "SELECT "
    + ", ".join(
        _side(column, group, f"{name}_{side}")
        for name, column in (("n", "n"), ("salario", "avg_salary"), ("senior", "pct_senior"))
        for side, group in (("f", WOMEN), ("m", MEN))
    )
    + " FROM gender_gap WHERE survey_year = :year",
    "q_tech_2025": "SELECT technology, adoption_pct, n FROM tech_adoption WHERE survey_year = :year ORDER BY adoption_pct DESC",
    "q_tech_trend": f"""SELECT survey_year, technology, adoption_pct FROM tech_adoption
        WHERE technology IN ({literals(TREND_TOOLS)}) ORDER BY technology, survey_year""",
    "q_genai_by_family": """SELECT job_family, round(sum(pct_uses_genai * n) / sum(n), 1) AS pct_genai, sum(n) AS n
        FROM ai_adoption WHERE survey_year = :year GROUP BY job_family ORDER BY pct_genai DESC""",
    "q_region": _total("region_group"),
    "q_work_model": _total("work_model_group"),
    "q_work_model_salary": """SELECT work_model_group, sum(n) AS n, round(sum(avg_salary * n) / sum(n), 0) AS salario
        FROM region_work_model WHERE survey_year = :year AND avg_salary IS NOT NULL
        GROUP BY work_model_group ORDER BY salario DESC""",
    "q_region_sudeste": f"""SELECT work_model_group, n, avg_salary FROM region_work_model
        WHERE survey_year = :year AND region_group = {literal(FOCUS_REGION)} ORDER BY n DESC""",
    "q_top_sectors": f"""SELECT sector, n, avg_salary FROM sector
        WHERE survey_year = :year AND trim(sector) <> '' ORDER BY n DESC, sector LIMIT {TOP_SECTORS}""",
}


def ask(spark: SparkSession, name: str, gold: Mapping[str, DataFrame], year: int = LATEST) -> DataFrame:
    """Run a named statement with the gold tables registered as views."""
    register_views(gold)
    statement = STATEMENTS[name]
    return spark.sql(statement, args={"year": year} if ":year" in statement else None)
