"""The nine gold tables, each a function of respondent cells (see ``cells``)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.fixed_values import (
    MEN,
    MIN_AI_GROUP,
    MIN_SALARY_GROUP,
    MIN_SECTOR_GROUP,
    TOOLS,
    WOMEN,
)
from surveymill.functions.measures import ratio, share_of_total
from surveymill.plans import cells as c
from surveymill.sources.lake import read_gold, read_silver, remove, stage, write_gold, write_gold_csv


def _employed(cells: DataFrame) -> DataFrame:
    return cells.filter("is_employed = 1")


def _size(name: str = "n") -> Column:
    return F.sum("n").alias(name)


def _salary(name: str = "avg_salary") -> Column:
    return ratio("salary_sum", "salary_n", 0).alias(name)


def _pct(part: str, base: str) -> Column:
    return ratio(part, base, 1, scale=100)


def overview(cells: DataFrame) -> DataFrame:
    """Per edition: size, employment, women, remote work, pay, main tools, generative AI."""
    tools = [
        _pct(f"{tool}_sum", f"{tool}_n").alias(f"pct_{tool.removeprefix('uses_')}")
        for tool in ("uses_python", "uses_sql", "uses_aws")
    ]
    return (
        cells.groupBy("survey_year", "edition")
        .agg(
            _size("respondents"),
            F.sum(F.col("is_employed") * F.col("n")).alias("employed"),
            _pct("women", "n").alias("pct_women"),
            _pct("remote", "n").alias("pct_remote"),
            _salary("avg_salary_midpoint"),
            *tools,
            _pct("genai_sum", "genai_n").alias("pct_genai"),
        )
        .orderBy("survey_year")
    )


def market_structure(cells: DataFrame) -> DataFrame:
    """Job families of the employed and their share of the year."""
    families = _employed(cells).groupBy("survey_year", "job_family").agg(_size("professionals"))
    return share_of_total(families, "professionals", "survey_year").orderBy("survey_year", F.desc("professionals"))


def salary_role_seniority(cells: DataFrame) -> DataFrame:
    """Pay by family and level, over the employed who gave a salary."""
    keys = ("survey_year", "job_family", "seniority_group")
    return (
        _employed(cells)
        .groupBy(*keys)
        .agg(F.sum("salary_n").alias("n"), _salary())
        .filter(F.col("n") >= MIN_SALARY_GROUP)
        .orderBy(*keys)
    )


def gender(cells: DataFrame) -> DataFrame:
    """Size and pay by gender, family and level, over everybody."""
    return (
        cells.groupBy("survey_year", "gender_group", "job_family", "seniority_group")
        .agg(_size(), _salary())
        .orderBy("survey_year", "gender_group")
    )


def gender_gap(cells: DataFrame) -> DataFrame:
    """Women and men among the employed: size, pay, share of seniors."""
    return (
        _employed(cells)
        .filter(F.col("gender_group").isin(WOMEN, MEN))
        .groupBy("survey_year", "gender_group")
        .agg(_size(), _salary(), _pct("seniors", "n").alias("pct_senior"))
    )


def tech_adoption(cells: DataFrame) -> DataFrame:
    """Adoption of each tool among the employed who answered the tool questions.

    All tools are measured in one aggregation; its few rows (one per year) are then unpivoted.
    A tool nobody was asked about keeps its row, without a percentage.
    """
    wide = (
        _employed(cells)
        .filter("answered_tools")
        .groupBy("survey_year")
        .agg(_size(), *[_pct(f"{tool}_sum", f"{tool}_n").alias(label) for tool, label in TOOLS.items()])
    )
    return (
        wide.unpivot(["survey_year", "n"], list(TOOLS.values()), "technology", "adoption_pct")
        .select("survey_year", "adoption_pct", "n", "technology")
        .orderBy("survey_year", F.desc("adoption_pct"))
    )


def region_work_model(cells: DataFrame) -> DataFrame:
    """Where and how the employed work."""
    return (
        _employed(cells)
        .groupBy("survey_year", "region_group", "work_model_group")
        .agg(_size(), _salary())
        .orderBy("survey_year", "region_group")
    )


def ai_adoption(cells: DataFrame) -> DataFrame:
    """Generative AI by family and level, over those who answered."""
    return (
        cells.groupBy("survey_year", "job_family", "seniority_group")
        .agg(
            F.sum("genai_n").alias("n"),
            _pct("genai_sum", "genai_n").alias("pct_uses_genai"),
            ratio("genai_salary_sum", "genai_salary_n", 0).alias("avg_salary"),
        )
        .filter(F.col("n") >= MIN_AI_GROUP)
    )


def sector(cells: DataFrame) -> DataFrame:
    """Employed per sector as answered; the unanswered stay a group of their own."""
    return (
        _employed(cells)
        .groupBy("survey_year", "sector")
        .agg(_size(), _salary())
        .filter(F.col("n") >= MIN_SECTOR_GROUP)
        .orderBy("survey_year", F.desc("n"))
    )


# table -> (function, cell set it reads)
GOLD_TABLES = {
    "overview": (overview, "edition"),
    "market_structure": (market_structure, "role"),
    "salary_role_seniority": (salary_role_seniority, "role"),
    "gender": (gender, "role"),
    "gender_gap": (gender_gap, "role"),
    "tech_adoption": (tech_adoption, "edition"),
    "region_work_model": (region_work_model, "place"),
    "ai_adoption": (ai_adoption, "role"),
    "sector": (sector, "sector"),
}
# cell sets that serve several tables -> (categories, measures); the others are read as they are
_SHARED_CELLS = {
    "edition": (c.EDITION_KEYS, c.EDITION_MEASURES),
    "role": (c.ROLE_KEYS, c.ROLE_MEASURES),
}
CELL_SETS = {**_SHARED_CELLS, "place": (c.PLACE_KEYS, c.PLACE_MEASURES), "sector": (c.SECTOR_KEYS, c.PLACE_MEASURES)}


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """All gold tables as lazy queries on the respondents, one scan each."""
    return {name: table(c.units(silver)) for name, (table, _) in GOLD_TABLES.items()}


def build_gold(spark: SparkSession, silver: str, gold: str, csv: str | None = None) -> dict[str, DataFrame]:
    """Write all gold tables (and CSV copies) and return them as read back.

    Cell sets that serve several tables are written to a work folder beside them first, so the
    respondents are scanned four times for nine tables. The four branches do not depend on each
    other and are submitted side by side. The work folder is removed when all tables are written.
    """
    units, work = c.units(read_silver(spark, silver)), f"{gold.rstrip('/')}/_cells-{uuid.uuid4().hex}"

    def write_branch(cell_set: str) -> None:
        cells = units
        if cell_set in _SHARED_CELLS:
            cells = stage(c.add_up(units, *_SHARED_CELLS[cell_set]), f"{work}/{cell_set}")
        for name, (table, source) in GOLD_TABLES.items():
            if source == cell_set:
                write_gold(table(cells), f"{gold.rstrip('/')}/{name}")

    branches = {source for _, source in GOLD_TABLES.values()}
    with ThreadPoolExecutor(len(branches)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write_branch), branches))
    remove(spark, work)
    tables = read_gold(spark, gold, GOLD_TABLES)
    if csv is not None:
        for name, table in tables.items():
            write_gold_csv(table, f"{csv.rstrip('/')}/{name}")
    return tables


def cell_store(gold: str, cell_set: str) -> str:
    return f"{gold.rstrip('/')}/_store/{cell_set}"


def changed_cells(silver: DataFrame, cell_set: str, years: Iterable[int]) -> DataFrame:
    """The cells of some years, of a set. Only these years' partitions of the respondents are read."""
    return c.add_up(c.units(silver.filter(F.col("survey_year").isin(*years))), *CELL_SETS[cell_set])


def update_gold(spark: SparkSession, silver: str, gold: str, years: Iterable[int], csv: str | None = None) -> dict[str, DataFrame]:
    """Bring all gold tables up to date after the respondents of some years have changed.

    Cells are kept in a store partitioned by year beside the tables. The years' partitions are made anew and replace the old ones;
    the tables are added up from the store. The first call must name all years. A year whose respondents are gone
    loses its cells.
    """
    years = sorted(set(years))
    respondents = read_silver(spark, silver)
    there = [row[0] for row in respondents.filter(F.col("survey_year").isin(*years)).select("survey_year").distinct().collect()]

    def update(cell_set: str) -> None:
        store = cell_store(gold, cell_set)
        cells = changed_cells(respondents, cell_set, years)
        cells.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("survey_year").parquet(store)
        for year in set(years) - set(there):
            remove(spark, f"{store}/survey_year={year}")
        kept = spark.read.schema(cells.schema).parquet(store)
        for name, (table, source) in GOLD_TABLES.items():
            if source == cell_set:
                write_gold(table(kept), f"{gold.rstrip('/')}/{name}")

    with ThreadPoolExecutor(len(CELL_SETS)) as pool:
        list(pool.map(inheritable_thread_target(spark)(update), CELL_SETS))
    tables = read_gold(spark, gold, GOLD_TABLES)
    if csv is not None:
        for name, table in tables.items():
            write_gold_csv(table, f"{csv.rstrip('/')}/{name}")
    return tables
