"""Respondent rows: the canonical schema contract and the derived columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from surveymill.fixed_values import (
    DERIVED_FIELDS,
    EMPLOYED_PHRASES,
    FLAG_FIELDS,
    GENAI_ANSWERS,
    GENAI_DENIALS,
    GENAI_USE_FLAGS,
    GENDERS,
    INPUT_FIELDS,
    JOB_FAMILIES,
    MANAGEMENT,
    NOT_INFORMED,
    OTHERS,
    SALARY_MIDPOINTS,
    SENIORITIES,
    WORK_MODELS,
)
from surveymill.functions.labels import first_label, lookup
from surveymill.functions.text import contains_any, literal, to_flag

INPUT_SCHEMA = StructType(
    [
        StructField(
            field,
            IntegerType() if field == "survey_year" or field in FLAG_FIELDS else StringType(),
            field != "survey_year",
        )
        for field in INPUT_FIELDS
    ]
)
SILVER_COLUMNS = INPUT_FIELDS + DERIVED_FIELDS
_NUMBERS = {"salary_midpoint": DoubleType(), "is_employed": IntegerType(), "uses_genai": IntegerType()}
SILVER_SCHEMA = StructType(
    [*INPUT_SCHEMA, *(StructField(name, _NUMBERS.get(name, StringType())) for name in DERIVED_FIELDS)]
)


def contract(source: DataFrame, answers: Mapping[str, str], *extra: str) -> DataFrame:
    """Project raw answers onto the input schema, in order; fields without an answer are null.

    ``answers`` maps a field to the SQL expression of its raw text, evaluated once in a first
    projection; the second one values the flags. ``extra`` columns of the source go in front.
    """
    raw, typed = [], []
    for field in INPUT_SCHEMA:
        name, kind = field.name, field.dataType.simpleString()
        if name not in answers:
            typed.append(f"CAST(NULL AS {kind}) AS {name}")
        elif name in FLAG_FIELDS:
            raw.append(f"{answers[name]} AS {name}")
            typed.append(f"{to_flag(name)} AS {name}")
        else:
            raw.append(f"CAST({answers[name]} AS {kind}) AS {name}")
            typed.append(name)
    return source.selectExpr(*extra, *raw).selectExpr(*extra, *typed)


# Texts the rules read, lowered once per row: every rule asks for its text many times.
_LOWERED = ("job_title", "work_model", "gender", "seniority", "salary_band", "work_status", "genai_use_text")

_NO_GENAI_ANSWER = " AND ".join(f"{answer} IS NULL" for answer in GENAI_ANSWERS)
_GENAI_FLAGGED = " OR ".join(f"{flag} <=> 1" for flag in GENAI_USE_FLAGS)

# Derived column -> expression on the input fields and the lowered texts.
DERIVATIONS = {
    "job_family": first_label(
        "lowered_job_title",
        JOB_FAMILIES,
        ("trim(lowered_job_title) = '' AND is_manager <=> 1", MANAGEMENT),
        ("trim(lowered_job_title) = ''", NOT_INFORMED),
        default=literal(OTHERS),
    ),
    "work_model_group": first_label(
        "lowered_work_model", WORK_MODELS, ("lowered_work_model = ''", NOT_INFORMED), default=literal(OTHERS)
    ),
    "gender_group": first_label(
        "lowered_gender", GENDERS, ("lowered_gender = ''", NOT_INFORMED), default=literal(OTHERS)
    ),
    "seniority_group": first_label(
        "lowered_seniority", SENIORITIES, ("lowered_seniority = ''", NOT_INFORMED), default="initcap(seniority)"
    ),
    "salary_midpoint": lookup("lowered_salary_band", SALARY_MIDPOINTS),
    "is_employed": f"CAST({contains_any('lowered_work_status', EMPLOYED_PHRASES)} AS INT)",
    # null only when none of the questions was answered
    "uses_genai": f"""IF({_NO_GENAI_ANSWER}, NULL, CAST(
        {_GENAI_FLAGGED}
        OR NOT (lowered_genai_use_text RLIKE '^$' OR {contains_any('lowered_genai_use_text', GENAI_DENIALS)})
        AS INT))""",
    "region_group": f"IF(trim(coalesce(region, '')) = '', {literal(NOT_INFORMED)}, initcap(region))",
}


def enrich(respondents: DataFrame, fields=DERIVED_FIELDS) -> DataFrame:
    """Append the derived columns."""
    lowered = [f"lower(coalesce({column}, '')) AS lowered_{column}" for column in _LOWERED]
    derived = [f"{DERIVATIONS[field]} AS {field}" for field in fields]
    return respondents.selectExpr("*", *lowered).selectExpr(*respondents.columns, *derived)


def violations() -> list[Column]:
    """Counts of rows, and of what the contract of the respondent table forbids: rows without year, flags that are
    neither 0, 1 nor null, salary bands without a midpoint."""
    bad_flags = " + ".join(f"IF(coalesce({flag}, 0) NOT IN (0, 1), 1L, 0L)" for flag in FLAG_FIELDS)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("survey_year").isNull()).alias("null_years"),
        F.sum(F.expr(bad_flags)).alias("bad_flags"),
        F.count_if(F.expr("salary_band IS NOT NULL AND salary_midpoint IS NULL")).alias("unknown_bands"),
    ]
