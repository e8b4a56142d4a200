"""The analyses, one function each: (gold table, year) -> DataFrame.

Every analysis reads one gold table; ``ANALYSES`` names it. Questions about one year default to
the latest registered edition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveymill.fixed_values import (
    EDITIONS,
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
from surveymill.functions.measures import pick, weighted_mean

LATEST = max(EDITIONS)


def _of(table: DataFrame, year: int) -> DataFrame:
    return table.where(F.col("survey_year") == year)


def overview(table: DataFrame, year: int = LATEST) -> DataFrame:
    return table.orderBy("survey_year")


def market(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year).orderBy(F.desc("professionals"))


def market_ascending(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year).orderBy("professionals")


def market_trend(table: DataFrame, year: int = LATEST) -> DataFrame:
    families = table.where(F.col("job_family").isin(*TREND_FAMILIES))
    return families.select("survey_year", "job_family", "share_pct").orderBy("job_family", "survey_year")


def _level(table: DataFrame, year: int, level: str) -> DataFrame:
    return _of(table, year).where(F.col("seniority_group") == level)


def salary_senior(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _level(table, year, SENIOR).select("job_family", "avg_salary", "n").orderBy(F.desc("avg_salary"))


def salary_senior_ascending(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _level(table, year, SENIOR).orderBy("avg_salary")


def salary_ladder(table: DataFrame, year: int = LATEST) -> DataFrame:
    keys = ("job_family", "seniority_group")
    steps = _of(table, year).where(
        F.col("job_family").isin(*LADDER_FAMILIES) & F.col("seniority_group").isin(*LADDER_LEVELS)
    )
    return steps.select(*keys, "n", "avg_salary").orderBy(*keys)


def salary_staff(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _level(table, year, STAFF_LEVEL).select("job_family", "n", "avg_salary").orderBy(F.desc("avg_salary"))


def gender(table: DataFrame, year: int = LATEST) -> DataFrame:
    return table.orderBy("survey_year", "gender_group")


def gender_rows(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year)


def gender_pivot(table: DataFrame, year: int = LATEST) -> DataFrame:
    """Women and men side by side, in one row."""
    measures = {"n": "n", "salario": "avg_salary", "senior": "pct_senior"}
    sides = {"f": WOMEN, "m": MEN}
    return _of(table, year).agg(
        *[
            pick(column, "gender_group", group).alias(f"{name}_{side}")
            for name, column in measures.items()
            for side, group in sides.items()
        ]
    )


def tech(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year).select("technology", "adoption_pct", "n").orderBy(F.desc("adoption_pct"))


def tech_rows(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year).orderBy(F.desc("adoption_pct"))


def tech_ascending(table: DataFrame, year: int = LATEST) -> DataFrame:
    return _of(table, year).orderBy(F.asc_nulls_last("adoption_pct"))


def tech_trend(table: DataFrame, year: int = LATEST) -> DataFrame:
    tools = table.where(F.col("technology").isin(*TREND_TOOLS))
    return tools.select("survey_year", "technology", "adoption_pct").orderBy("technology", "survey_year")


def genai_by_family(table: DataFrame, year: int = LATEST) -> DataFrame:
    by_family = _of(table, year).groupBy("job_family")
    return by_family.agg(
        weighted_mean("pct_uses_genai", "n", 1).alias("pct_genai"), F.sum("n").alias("n")
    ).orderBy(F.desc("pct_genai"))


def regions(table: DataFrame, year: int = LATEST) -> DataFrame:
    by_region = _of(table, year).groupBy("region_group")
    return by_region.agg(F.sum("n").alias("n")).orderBy(F.desc("n"))


def work_models(table: DataFrame, year: int = LATEST) -> DataFrame:
    by_model = _of(table, year).groupBy("work_model_group")
    return by_model.agg(F.sum("n").alias("n")).orderBy(F.desc("n"))


def work_model_salary(table: DataFrame, year: int = LATEST) -> DataFrame:
    """Mean pay per work model, regions weighted with all their people."""
    paid = _of(table, year).where(F.col("avg_salary").isNotNull())
    return (
        paid.groupBy("work_model_group")
        .agg(F.sum("n").alias("n"), weighted_mean("avg_salary", "n", 0).alias("salario"))
        .orderBy(F.desc("salario"))
    )


def region_focus(table: DataFrame, year: int = LATEST, region: str = FOCUS_REGION) -> DataFrame:
    rows = _of(table, year).where(F.col("region_group") == region)
    return rows.select("work_model_group", "n", "avg_salary").orderBy(F.desc("n"))


def top_sectors(table: DataFrame, year: int = LATEST, k: int = TOP_SECTORS) -> DataFrame:
    """The k largest named sectors; equal sizes go by name."""
    named = _of(table, year).where(F.trim("sector") != "")
    return named.select("sector", "n", "avg_salary").orderBy(F.desc("n"), "sector").limit(k)


# analysis -> (function, gold table it reads)
ANALYSES = {
    "q_overview": (overview, "overview"),
    "q_market_2025": (market, "market_structure"),
    "q_market_trend": (market_trend, "market_structure"),
    "q_salary_senior": (salary_senior, "salary_role_seniority"),
    "q_salary_ladder": (salary_ladder, "salary_role_seniority"),
    "q_salary_staff": (salary_staff, "salary_role_seniority"),
    "q_gender": (gender, "gender_gap"),
    "q_gender_pivot": (gender_pivot, "gender_gap"),
    "q_tech_2025": (tech, "tech_adoption"),
    "q_tech_trend": (tech_trend, "tech_adoption"),
    "q_genai_by_family": (genai_by_family, "ai_adoption"),
    "q_region": (regions, "region_work_model"),
    "q_work_model": (work_models, "region_work_model"),
    "q_work_model_salary": (work_model_salary, "region_work_model"),
    "q_region_sudeste": (region_focus, "region_work_model"),
    "q_top_sectors": (top_sectors, "sector"),
    "tech_2025": (tech_rows, "tech_adoption"),
    "market_2025_asc": (market_ascending, "market_structure"),
    "senior_salary_asc": (salary_senior_ascending, "salary_role_seniority"),
    "gender_2025": (gender_rows, "gender"),
    "tech_2025_asc": (tech_ascending, "tech_adoption"),
}


def analyse(name: str, gold: Mapping[str, DataFrame], year: int = LATEST) -> DataFrame:
    """Run a named analysis on the gold tables."""
    question, table = ANALYSES[name]
    return question(gold[table], year)
