"""Survey data made from the given ``orders`` table by arithmetic, as SQL both engines run.

``{orders}``, ``{array}`` and ``{pick}`` are the places of the table and of the engine's names
for a list and its n-th element. All values are synthetic and every row of ``orders`` becomes one
respondent (or one header), so the work grows with the table.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.fixed_values import EDITIONS, NULL_TOKENS
from surveymill.operators.respondents import contract
from surveymill.sources.editions import edition_path
from surveymill.sources.lake import work_folder  # noqa: F401 (the queries' folder)

# field -> (number made from the order, answers); the answer at number % len(answers) is taken.
ANSWERS = {
    "edition": ("o_orderkey", ("2023-2024", "2024-2025", "2025-2026")),
    "job_title": (
        "o_custkey * 31 + o_orderkey",
        (
            "Cientista de Dados/Data Scientist", "Data Scientist", "Engenheiro de Machine Learning/ML Engineer",
            "Engenheiro de Dados/Data Engineer", "Arquiteto de Dados", "Analytics Engineer",
            "Analista de Dados/Data Analyst", "DATA ANALYST", "Analista de BI/BI Analyst",
            "Analista de Negócios/Business Analyst", "Data Product Manager",
            "Desenvolvedor/Engenheiro de Software", "Analista de Negócios", "  ", None, "Professor",
        ),
    ),
    "is_manager": ("o_custkey", ("Sim", "1.0", "não", "0", None)),
    "seniority": (
        "o_custkey * 7 + o_orderkey",
        (
            "Júnior", "Junior", "Pleno", "PLENO", "Sênior", "Senior", "Sênior", "Especialista/Staff+", "Gerente",
            None, "Pleno",
        ),
    ),
    "gender": (
        "o_orderkey * 13 + o_custkey",
        (
            "Feminino", "Mulher cis", "Masculino", "Homem", "Masculino", "Prefiro não informar", None,
        ),
    ),
    "region": (
        "o_orderkey * 17 + o_custkey",
        (
            "Sudeste", "sudeste", "Sul", "Nordeste", "Centro-oeste", "RIO grande", "  ", None,
        ),
    ),
    "work_model": (
        "o_orderkey * 19 + o_custkey",
        (
            "Modelo 100% remoto", "Modelo híbrido flexível", "Hybrid", "Modelo 100% presencial", "Outro arranjo",
            "", None,
        ),
    ),
    "salary_band": (
        "o_orderkey * 23 + o_custkey",
        (
            "Menos de R$ 1.000/mês", "de R$ 1.001/mês a R$ 2.000/mês", "de R$ 2.001/mês a R$ 3.000/mês",
            "de R$ 3.001/mês a R$ 4.000/mês", "de R$ 4.001/mês a R$ 6.000/mês", "de R$ 6.001/mês a R$ 8.000/mês",
            "de R$ 8.001/mês a R$ 12.000/mês", "de R$ 12.001/mês a R$ 16.000/mês",
            "de R$ 16.001/mês a R$ 20.000/mês", "de R$ 20.001/mês a R$ 25.000/mês",
            "de R$ 25.001/mês a R$ 30.000/mês", "de R$ 30.001/mês a R$ 40.000/mês", "Acima de R$ 40.001/mês",
            "faixa desconhecida", None,
        ),
    ),
    "work_status": (
        "o_orderkey * 29 + o_custkey",
        (
            "Empregado (CLT)", "Empreendedor ou Empregado (CNPJ)", "Servidor Público", "Freelancer",
            "Desempregado", "Empregado (CLT)", "Estagiário", None,
        ),
    ),
    "uses_python": ("o_orderkey * 37 + o_custkey", ("Sim", "1", "0.0", "False", " TRUE ", "Python", "nan", "", None)),
    "uses_sql": ("o_orderkey * 41 + o_custkey", ("1.0", "0.0", "yes", "no", None, "1")),
    "uses_aws": ("o_orderkey * 43 + o_custkey", ("1", "0", None, "0")),
    "genai_free": ("o_orderkey * 47 + o_custkey", ("1", "0", None, None, None)),
    "genai_not_used": ("o_orderkey * 53 + o_custkey", ("1", "0", None, None, None, None)),
    "uses_gcp": ("o_orderkey * 61 + o_custkey", ("1", "0", None, "0")),
    "uses_azure": ("o_orderkey * 67 + o_custkey", ("1", "0", None, "0", "0")),
    "uses_powerbi": ("o_orderkey * 71 + o_custkey", ("1", "0", None)),
    "uses_tableau": ("o_orderkey * 73 + o_custkey", ("1", "0", None, "0", "0", "0", "0")),
    "uses_databricks": ("o_orderkey * 79 + o_custkey", ("1", "0", None, "0", "0", "0")),
    "genai_paid_self": ("o_orderkey * 89 + o_custkey", ("1", "0", None, None, None, None, None, None, None)),
    "genai_paid_company": ("o_orderkey * 97 + o_custkey", ("1", "0", None, None, None, None, None, None)),
    "genai_copilot": ("o_orderkey * 101 + o_custkey", ("1", "0", None, None, None, None, None, None, None, None)),
    "genai_use_text": (
        "o_orderkey * 59 + o_custkey",
        (
            "Uso o ChatGPT no trabalho", "Não utilizo", "nao utilizo", None, None,
        ),
    ),
}


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(number: str, values) -> str:
    """The value at ``number`` modulo the length of the list."""
    return f"{{pick}}({{array}}({', '.join(map(_literal, values))}), CAST(({number}) % {len(values)} AS INT) + 1)"


_ANSWERS = ",\n  ".join(f"{_pick(number, values)} AS {field}" for field, (number, values) in ANSWERS.items())

RESPONDENTS = f"""
SELECT o_orderkey AS resp_id, CAST(2023 + o_orderkey % 3 AS INT) AS survey_year,
  {_ANSWERS},
  CASE WHEN o_orderkey % 499 = 93 THEN 'Setor raro'
       WHEN o_orderkey % 97 < 90 THEN CONCAT('Setor ', CAST(o_custkey % 12 AS VARCHAR(8)))
       WHEN o_orderkey % 97 < 93 THEN ' ' END AS sector,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
       WHEN (o_orderkey * 83 + o_custkey) % 6 = 0 THEN '1' ELSE '0' END AS uses_snowflake
FROM {{orders}}
"""

# Respondents as a survey file holds them: more text columns, with line breaks, quotes, commas
# and null tokens in the cells. ``age`` carries the respondent id.
RAW_ANSWERS = f"""
SELECT r.*,
  CAST(resp_id AS VARCHAR(20)) AS age,
  CONCAT('Faixa ', CAST(resp_id % 6 AS VARCHAR(8))) AS age_band,
  CONCAT('Área ', CAST(resp_id % 7 AS VARCHAR(8)), chr(10), 'cita "dados", e mais', chr(10)) AS job_function,
  CASE resp_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan' WHEN 2 THEN 'mais de 4 anos'
    WHEN 3 THEN 'None' WHEN 4 THEN '' ELSE ' "3" ' END AS experience,
  CASE resp_id % 4 WHEN 0 THEN 'Ensino, superior' WHEN 1 THEN '#N/A'
    WHEN 2 THEN 'null' ELSE 'Null' END AS education
FROM ({RESPONDENTS}) r
"""

# What each edition calls its columns: field -> header.
EDITION_HEADERS = {
    2023: {
        "age": "('P1_a ', 'Idade')",
        "age_band": "('P1_a_1 ', 'Faixa idade')",
        "gender": "('P1_b ', 'Gênero')",
        "region": "('P1_i_2 ', 'Regiao onde mora')",
        "education": "('P1_l ', 'Nivel de Ensino')",
        "work_status": "('P2_a ', 'Qual sua situação atual de trabalho?')",
        "sector": "('P2_b ', 'Setor')",
        "is_manager": "('P2_d ', 'Gestor?')",
        "job_title": "('P2_f ', 'Cargo Atual')",
        "seniority": "('P2_g ', 'Nivel')",
        "salary_band": "('P2_h ', 'Faixa salarial')",
        "experience": "('P2_i ', 'Quanto tempo de experiência na área de dados você tem?')",
        "work_model": "('P2_r ', 'Atualmente qual a sua forma de trabalho?')",
        "uses_sql": "('P4_d_1 ', 'SQL')",
        "uses_python": "('P4_d_3 ', 'Python')",
        "uses_azure": "('P4_h_1 ', 'Azure (Microsoft)')",
        "uses_aws": "('P4_h_2 ', 'Amazon Web Services (AWS)')",
        "uses_gcp": "('P4_h_3 ', 'Google Cloud (GCP)')",
        "uses_powerbi": "('P4_j_1 ', 'Microsoft PowerBI')",
        "uses_tableau": "('P4_j_3 ', 'Tableau')",
        "uses_databricks": "('P4_g_8 ', 'Databricks')",
        "job_function": "('P4_a ', 'Função de atuação')",
        "genai_use_text": "('P4_l ', 'Utiliza ChatGPT ou LLMs no trabalho?')",
        "genai_not_used": "('P4_m_1 ', 'Não uso soluções de AI Generativa com foco em produtividade')",
        "genai_free": "('P4_m_2 ', 'Uso soluções gratuitas de AI Generativa (ChatGPT)')",
        "genai_paid_self": "('P4_m_3 ', 'Uso e pago pelas soluções de AI Generativa')",
        "genai_paid_company": "('P4_m_4 ', 'A empresa que trabalho paga pelas soluções de AI Generativa')",
        "genai_copilot": "('P4_m_5 ', 'Uso soluções do tipo Copilot')",
    },
    2024: {
        "age": "P1_a - Idade",
        "age_band": "P1_a_1 - Faixa de idade",
        "gender": "P1_b - GENERO",
        "region": "P1_i_2 - Região onde mora",
        "education": "P1_l - Nível de ensino",
        "work_status": "P2_a - Situação atual de trabalho",
        "sector": "P2_b - Setor",
        "is_manager": "P2_d - Atua como gestor",
        "job_title": "P2_f - Cargo atual",
        "seniority": "P2_g - Nível",
        "salary_band": "P2_h - Faixa salarial",
        "experience": "P2_i - Tempo de experiência em dados",
        "work_model": "P2_r - Modelo de trabalho atual",
        "uses_sql": "4.c.1 SQL",
        "uses_python": "4.c.3 Python",
        "uses_azure": "4.h.1 Microsoft Azure",
        "uses_aws": "4.h.2 Amazon Web Services",
        "uses_gcp": "4.h.3 Google Cloud Platform",
        "uses_powerbi": "4.g.1 Power BI",
        "uses_tableau": "4.g.3 Tableau",
        "uses_databricks": "4.k.8 Databricks",
        "uses_snowflake": "4.k.9 Snowflake",
        "job_function": "4.a Função",
        "genai_use_text": "4.l ChatGPT no trabalho",
        "genai_not_used": "4.m.1 Não utilizo IA generativa",
        "genai_free": "4.m.2 Soluções gratuitas de AI Generativa",
        "genai_paid_self": "4.m.3 Pago do meu bolso",
        "genai_paid_company": "4.m.4 A empresa paga AI Generativa",
        "genai_copilot": "4.m.5 Copilot",
    },
    2025: {
        "age": "1.a_idade",
        "age_band": "1.a.1_faixa_idade",
        "gender": "1.b_genero",
        "region": "1.i.2_regiao_onde_mora",
        "education": "1.l_nivel_de_ensino",
        "work_status": "2.a_situação_de_trabalho",
        "sector": "2.b_setor",
        "is_manager": "2.d_atua_como_gestor",
        "job_title": "2.f_cargo_atual",
        "seniority": "2.g_nivel",
        "salary_band": "2.h_faixa_salarial",
        "experience": "2.i_tempo_de_experiencia_em_dados",
        "work_model": "2.r_modelo_de_trabalho_atual",
        "uses_sql": "4.d.1_SQL",
        "uses_python": "4.d.3_Python",
        "uses_azure": "4.h.1_Azure (Microsoft)",
        "uses_aws": "4.h.2_Amazon Web Services (AWS)",
        "uses_gcp": "4.h.3_Google Cloud (GCP)",
        "uses_powerbi": "4.j.1_Microsoft PowerBI",
        "uses_tableau": "4.j.3_Tableau",
        "uses_databricks": "4.g.8_Databricks",
        "uses_snowflake": "4.g.9_Snowflake",
        "job_function": "4.a.1_função_de_atuação",
        "genai_use_text": "4.l_utiliza_chatgpt_no_trabalho",
        "genai_not_used": "4.m.1_nao_uso_solucoes_de_ai_generativa",
        "genai_free": "4.m.2_solucoes_gratuitas_de_ai_generativa",
        "genai_paid_self": "4.m.3_uso_e_pago_pelas_solucoes_de_ai_generativa",
        "genai_paid_company": "4.m.4_a_empresa_paga_pelas_solucoes_de_ai_generativa",
        "genai_copilot": "4.m.5_copilot",
    },
}
# One more column per edition that no field may take.
DECOY_HEADERS = {
    2023: "('P2_s ', 'Qual a forma de trabalho ideal para você?')",
    2024: "4.i Ferramentas de dashboard (Power BI, Tableau)",
    2025: "4.k.2_MySQL",
}

# Headers for catalogs of many editions: (code in quoted style, code in dotted style, text).
CATALOG_HEADERS = (
    ("P1_a", "1.a", "Idade"), ("P1_a_1", "1.a.1", "Faixa idade"), ("P1_b", "1.b", "Gênero"),
    ("P1_b_1", "1.b.1", "Identidade de gênero"), ("P1_c", "1.c", "Cor/raca/etnia"), ("P1_d", "1.d", "PCD"),
    ("P1_e", "1.e", "Experiência prejudicada devido a PCD"), ("P1_i", "1.i", "uf onde mora"),
    ("P1_i_1", "1.i.1", "Regiao onde mora"), ("P1_l", "1.l", "Nivel de Ensino"), ("P2_a", "2.a", "Situação atual"),
    ("P2_a_1", "2.a.1", "Situação na entrevista"), ("P2_b", "2.b", "Setor"), ("P2_b_1", "2.b.1", "Setor publico"),
    ("P2_c", "2.c", "Número de funcionários"), ("P2_d", "2.d", "Gestor?"), ("P2_d_1", "2.e", "Atua como gestor"),
    ("P2_f", "2.f", "Cargo Atual"), ("P2_g", "2.g", "Nivel"), ("P2_g_1", "2.g.1", "Nivel de cobranca"),
    ("P2_h", "2.h", "Faixa salarial"), ("P2_i", "2.i", "Quanto tempo de experiência em dados"),
    ("P2_j", "2.j", "Tempo de experiência em TI"), ("P2_r", "2.r", "Modelo de trabalho atual"),
    ("P2_r_1", "2.r.1", "Atualmente qual a sua forma de trabalho?"), ("P2_s", "2.s", "Forma de trabalho ideal"),
    ("P2_t", "2.t", "Forma de trabalho"), ("P3_e", "3.e", "AI Generativa é uma prioridade?"),
    ("P3_e_1", "3.e.1", "AI nos negócios"), ("P4_a", "4.a", "Função"), ("P4_a_1", "4.a.1", "Função de atuacao em dados"),
    ("P4_d_1", "4.d.1", "SQL"), ("P4_c_1", "4.c.1", "SQL"), ("P4_d_9", "4.d.9", "Linguagem SQL"),
    ("P4_e_1", "4.e.1", "SQL Server"), ("P4_e_2", "4.e.2", "NoSQL"), ("P4_d_3", "4.d.3", "Python"),
    ("P4_d_4", "4.d.4", "Scripts Python"), ("P4_h_1", "4.h.1", "Azure (Microsoft)"),
    ("P4_h_4", "4.h.4", "Azure Machine Learning (Microsoft)"), ("P4_h_2", "4.h.2", "Amazon Web Services (AWS)"),
    ("P4_h_3", "4.h.3", "Google Cloud (GCP)"), ("P4_j_1", "4.j.1", "Microsoft PowerBI"), ("P4_j_2", "4.j.2", "Power BI"),
    ("P4_i_1", "4.i.1", "PowerBI"), ("P4_k", "4.k", "Ferramentas PowerBI e Tableau"), ("P4_j_3", "4.j.3", "Tableau"),
    ("P4_j_4", "4.j.4", "Tableau Dashboards"), ("P4_g_8", "4.g.8", "Databricks"),
    ("P4_g_7", "4.g.7", "Databricks Feature Store"), ("P4_g_9", "4.g.9", "Snowflake"),
    ("P4_m_1", "4.m.1", "Não uso soluções de AI Generativa"), ("P4_m_6", "4.m.6", "Não utilizo IA generativa"),
    ("P4_m_2", "4.m.2", "Uso soluções gratuitas de AI Generativa (ChatGPT)"),
    ("P4_m_3", "4.m.3", "Uso e pago pelas soluções de AI Generativa"), ("P4_m_7", "4.m.7", "Pago do meu bolso"),
    ("P4_m_4", "4.m.4", "A empresa paga AI Generativa"), ("P4_m_5", "4.m.5", "Copilot"),
    ("P4_m_8", "4.m.8", "Copilot para desenvolvedores"), ("P4_l", "4.l", "Utiliza ChatGPT no trabalho?"),
    ("P4_z", "4.z", "Outros"),
)


_HEADER_NUMBER = "o_orderkey * 7 + o_custkey"

# One header per order, 48 to an edition; even editions quote them as tuples, odd ones use dots.
HEADER_CATALOG = f"""
SELECT survey_year, pos,
  CASE WHEN survey_year % 2 = 0 THEN CONCAT('(''', quoted, ' '', ''', label, ''')')
       ELSE CONCAT(dotted, '_', replace(label, ' ', '_')) END AS header
FROM (
  SELECT CAST(floor(o_orderkey / 48) AS INT) AS survey_year, CAST(o_orderkey % 48 AS INT) AS pos,
    {_pick(_HEADER_NUMBER, [quoted for quoted, _, _ in CATALOG_HEADERS])} AS quoted,
    {_pick(_HEADER_NUMBER, [dotted for _, dotted, _ in CATALOG_HEADERS])} AS dotted,
    {_pick(_HEADER_NUMBER, [label for _, _, label in CATALOG_HEADERS])} AS label
  FROM {{orders}}
) catalog
"""

# Cells of all kinds, for the null tokens.
CELLS = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 27 >= 24 THEN o_orderpriority
  ELSE {_pick("o_orderkey % 27", (*NULL_TOKENS, None, "Null", " NA", "none", "-", None, None, None))} END AS cell
FROM {{orders}}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_orders(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    text = sql.format(orders="{orders}", array="array", pick="element_at")
    return spark.sql(text, orders=table(spark, sf_dir, "orders"))


def respondents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The fixture on the input schema (flags normalised), ``extra`` columns in front."""
    raw = from_orders(spark, sf_dir, RESPONDENTS)
    return contract(raw, {name: name for name in raw.columns if name != "resp_id"}, *extra)


def write_bronze(spark: SparkSession, sf_dir: str, bronze: str) -> None:
    """The respondents as CSV editions, each with its own headers, and a file of blank lines in each."""
    raw = from_orders(spark, sf_dir, RAW_ANSWERS)

    def write(year: int) -> None:
        columns = [F.col(field).alias(header) for field, header in EDITION_HEADERS[year].items()]
        columns.insert(3, F.lit("decoy").alias(DECOY_HEADERS[year]))
        answers = raw.filter(F.col("survey_year") == year).select(*columns)
        write_csv(answers, edition_path(bronze, year))
        header = io.StringIO()
        csv.writer(header, lineterminator="").writerow(answers.columns)
        lines = [header.getvalue(), "", "   ", " \t ", ""]
        blank = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, line string")
        as_is = dict(sep="\x01", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        blank.coalesce(1).sortWithinPartitions("n").select("line").write.mode("append").options(**as_is).csv(
            edition_path(bronze, year)
        )

    with ThreadPoolExecutor(len(EDITIONS)) as pool:  # side by side, so that no edition waits for another's last task
        list(pool.map(write, EDITIONS))


def write_csv(frame: DataFrame, path: str) -> None:
    """Cells exactly as they are: untrimmed, quotes doubled."""
    frame.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
