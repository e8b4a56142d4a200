"""Every branch of the derived columns, on literal rows."""

from __future__ import annotations

import pytest

from surveymill.fixed_values import DERIVED_FIELDS, EMPLOYED_PHRASES, INPUT_FIELDS, SALARY_MIDPOINTS
from surveymill.operators.respondents import INPUT_SCHEMA, SILVER_COLUMNS, contract, enrich


def _derive(spark, field, **answers):
    row = tuple(2025 if f == "survey_year" else answers.get(f) for f in INPUT_FIELDS)
    return enrich(spark.createDataFrame([row], INPUT_SCHEMA), [field]).first()[field]


@pytest.mark.parametrize(
    "title, manager, family",
    [
        ("Cientista de Dados/Data Scientist", None, "Cientista de Dados"),
        ("DATA SCIENTIST", 1, "Cientista de Dados"),
        ("Cientista de Machine Learning", None, "Cientista de Dados"),
        ("Engenheiro de Machine Learning/ML Engineer/AI Engineer", None, "Engenheiro de ML/IA"),
        ("Arquiteto de Dados", None, "Engenharia de Dados"),
        ("Data Architect", None, "Engenharia de Dados"),
        ("Analytics Engineer", None, "Analytics Engineer"),
        ("Analista de Dados", None, "Analista de Dados"),
        ("Analista de BI", None, "Analista de BI"),
        ("Analista de Negócios", None, "Outros"),
        ("Analista de Negocios", None, "Analista de Negócios"),
        ("Analista de Negócios/Business Analyst", None, "Analista de Negócios"),
        ("DPM", None, "Data Product Manager"),
        ("Desenvolvedor", None, "Engenharia de Software"),
        ("", 1, "Gestão"),
        (None, 1, "Gestão"),
        ("   ", 0, "Não informado"),
        (None, None, "Não informado"),
        ("\t", 1, "Outros"),
        ("Professor", 1, "Outros"),
    ],
)
def test_job_family(spark, title, manager, family):
    assert _derive(spark, "job_family", job_title=title, is_manager=manager) == family


@pytest.mark.parametrize(
    "field, source, value, expected",
    [
        ("work_model_group", "work_model", "Modelo 100% Remoto", "Remoto"),
        ("work_model_group", "work_model", "100% remote", "Remoto"),
        ("work_model_group", "work_model", "Modelo HÍBRIDO", "Híbrido"),
        ("work_model_group", "work_model", "Hibrido (office)", "Híbrido"),
        ("work_model_group", "work_model", "Modelo híbrido", "Outros"),
        ("work_model_group", "work_model", "In office", "Presencial"),
        ("work_model_group", "work_model", None, "Não informado"),
        ("work_model_group", "work_model", "", "Não informado"),
        ("work_model_group", "work_model", " ", "Outros"),
        ("gender_group", "gender", "Woman", "Feminino"),
        ("gender_group", "gender", "Mulher cis", "Feminino"),
        ("gender_group", "gender", "Man", "Masculino"),
        ("gender_group", "gender", "Homem", "Masculino"),
        ("gender_group", "gender", "Prefiro não informar", "Outros"),
        ("gender_group", "gender", None, "Não informado"),
        ("gender_group", "gender", "  ", "Outros"),
        ("seniority_group", "seniority", "JUNIOR", "Júnior"),
        ("seniority_group", "seniority", "Júnior", "Júnior"),
        ("seniority_group", "seniority", "Pleno/Senior", "Pleno"),
        ("seniority_group", "seniority", "SÊNIOR", "Sênior"),
        ("seniority_group", "seniority", "Head de dados", "Gestão"),
        ("seniority_group", "seniority", "Especialista/Staff+", "Especialista/staff+"),
        ("seniority_group", "seniority", None, "Não informado"),
        ("seniority_group", "seniority", "  ", "  "),
        ("region_group", "region", "RIO grande", "Rio Grande"),
        ("region_group", "region", "Centro-oeste", "Centro-oeste"),
        ("region_group", "region", "   ", "Não informado"),
        ("region_group", "region", None, "Não informado"),
        ("salary_midpoint", "salary_band", "Acima de R$ 40.001/mês", 45000.0),
        ("salary_midpoint", "salary_band", " acima de R$ 40.001/mês", None),
        ("salary_midpoint", "salary_band", "de R$ 1.001/mes a R$ 2.000/mes", None),
        ("salary_midpoint", "salary_band", None, None),
        ("is_employed", "work_status", "Sou Empregado (CLT) hoje", 1),
        ("is_employed", "work_status", "Servidor Publico", 1),
        ("is_employed", "work_status", "Desempregado", 0),
        ("is_employed", "work_status", "", 0),
        ("is_employed", "work_status", None, 0),
    ],
)
def test_groups(spark, field, source, value, expected):
    assert _derive(spark, field, **{source: value}) == expected


def test_every_band_and_status(spark):
    for band, midpoint in SALARY_MIDPOINTS.items():
        assert _derive(spark, "salary_midpoint", salary_band=band.upper()) == midpoint
    for phrase in EMPLOYED_PHRASES:
        assert _derive(spark, "is_employed", work_status=f"- {phrase.upper()}.") == 1


@pytest.mark.parametrize(
    "answers, expected",
    [
        ({}, None),
        ({"genai_not_used": 1}, 0),
        ({"genai_not_used": 0}, 0),
        ({"genai_free": 0}, 0),
        ({"genai_free": 1}, 1),
        ({"genai_copilot": 1, "genai_not_used": 1}, 1),
        ({"genai_paid_self": 0, "genai_paid_company": 1}, 1),
        ({"genai_use_text": "Uso o ChatGPT"}, 1),
        ({"genai_use_text": "Não utilizo"}, 0),
        ({"genai_use_text": "NAO UTILIZO no trabalho, uso em casa"}, 0),
        ({"genai_use_text": ""}, 0),
        ({"genai_use_text": "\n"}, 0),
        ({"genai_use_text": " "}, 1),
        ({"genai_use_text": "Não utilizo", "genai_free": 1}, 1),
    ],
)
def test_uses_genai_has_three_values(spark, answers, expected):
    assert _derive(spark, "uses_genai", **answers) == expected


def test_contract_orders_types_and_fills_fields(spark):
    raw = spark.createDataFrame([("x", "Sim", "30", "n")], "edition string, py string, idade string, id string")
    rows = contract(raw, {"survey_year": "2024", "edition": "edition", "uses_python": "py", "age": "idade"}, "id")
    assert rows.columns == ["id", *INPUT_FIELDS]
    assert [f.dataType for f in rows.schema.fields[1:]] == [f.dataType for f in INPUT_SCHEMA]
    row = rows.first().asDict()
    assert (row["survey_year"], row["uses_python"], row["age"], row["uses_sql"]) == (2024, 1, "30", None)
    assert tuple(enrich(rows.drop("id")).columns) == SILVER_COLUMNS == INPUT_FIELDS + DERIVED_FIELDS
