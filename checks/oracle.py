"""DuckDB oracles: every registered query written again as plain SQL over the given tables.

The SQL follows the definitions directly (regular expressions, averages, windows, a rules table)
and shares no expression with the Spark code.
"""

from __future__ import annotations

from checks.catalog import GOLD_KEYS
from checks.fixture import CELLS, EDITION_HEADERS, HEADER_CATALOG, RAW_ANSWERS, RESPONDENTS
from surveymill.fixed_values import FLAG_FIELDS, HEADER_RULES, INPUT_FIELDS, NULL_TOKENS, SALARY_MIDPOINTS, TOOLS
from surveymill.plans.statements import STATEMENTS


def _orders(sql: str) -> str:
    return sql.format(orders="orders", array="list_value", pick="list_extract")


def _strings(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def _flag(column: str) -> str:
    text = f"lower(trim({column}))"
    return (
        f"CASE WHEN {column} IS NULL OR {text} IN ('', 'nan', '<na>') THEN NULL "
        f"WHEN TRY_CAST({text} AS DOUBLE) = 0 OR {text} IN ('false', 'nao', 'não', 'no') THEN 0 ELSE 1 END"
    )


def _initcap(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({column}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _low(column: str) -> str:
    return f"lower(coalesce({column}, ''))"


_RAW_FIELDS = (
    "edition", "job_title", "is_manager", "seniority", "gender", "region", "work_model", "salary_band",
    "work_status", "sector", "uses_python", "uses_sql", "uses_aws", "uses_gcp", "uses_azure", "uses_powerbi",
    "uses_tableau", "uses_databricks", "uses_snowflake", "genai_free", "genai_not_used", "genai_paid_self",
    "genai_paid_company", "genai_copilot", "genai_use_text",
)


def _inputs(available, nulls: bool = False) -> str:
    """The 35 input fields from raw text columns; with ``nulls``, null tokens are removed first."""

    def field(name: str) -> str:
        if name == "survey_year":
            return name
        kind = "INT" if name in FLAG_FIELDS else "VARCHAR"
        if name not in available:
            return f"CAST(NULL AS {kind}) AS {name}"
        if nulls and name != "edition":
            raw = f"(CASE WHEN {name} NOT IN ({_strings(NULL_TOKENS)}) THEN {name} END)"
        else:
            raw = name
        return f"CAST({_flag(raw) if name in FLAG_FIELDS else raw} AS {kind}) AS {name}"

    return ", ".join(field(name) for name in INPUT_FIELDS)


DERIVED = {
    "job_family": f"""CASE
  WHEN regexp_matches({_low('job_title')}, 'cientista|data scientist') THEN 'Cientista de Dados'
  WHEN regexp_matches({_low('job_title')}, 'machine learning|ml engineer|ai engineer') THEN 'Engenheiro de ML/IA'
  WHEN regexp_matches({_low('job_title')}, '(engenheiro|arquiteto) de dados|data (engineer|architect)') THEN 'Engenharia de Dados'
  WHEN regexp_matches({_low('job_title')}, 'analytics engineer') THEN 'Analytics Engineer'
  WHEN regexp_matches({_low('job_title')}, 'analista de dados|data analyst') THEN 'Analista de Dados'
  WHEN regexp_matches({_low('job_title')}, 'analista de bi|bi analyst') THEN 'Analista de BI'
  WHEN regexp_matches({_low('job_title')}, 'business analyst|analista de negocios') THEN 'Analista de Negócios'
  WHEN regexp_matches({_low('job_title')}, 'product manager|dpm') THEN 'Data Product Manager'
  WHEN regexp_matches({_low('job_title')}, 'desenvolvedor|engenheiro de software') THEN 'Engenharia de Software'
  WHEN (job_title IS NULL OR trim(job_title) = '') AND is_manager = 1 THEN 'Gestão'
  WHEN job_title IS NULL OR trim(job_title) = '' THEN 'Não informado'
  ELSE 'Outros' END""",
    "work_model_group": f"""CASE
  WHEN regexp_matches({_low('work_model')}, '100% remot[oe]') THEN 'Remoto'
  WHEN regexp_matches({_low('work_model')}, 'h[ií]brido|hybrid') THEN 'Híbrido'
  WHEN regexp_matches({_low('work_model')}, 'presencial|office') THEN 'Presencial'
  WHEN coalesce(work_model, '') = '' THEN 'Não informado' ELSE 'Outros' END""",
    "gender_group": f"""CASE
  WHEN regexp_matches({_low('gender')}, 'feminino|mulher|woman') THEN 'Feminino'
  WHEN regexp_matches({_low('gender')}, 'masculino|homem|man') THEN 'Masculino'
  WHEN coalesce(gender, '') = '' THEN 'Não informado' ELSE 'Outros' END""",
    "seniority_group": f"""CASE
  WHEN regexp_matches({_low('seniority')}, 'j[uú]nior') THEN 'Júnior'
  WHEN regexp_matches({_low('seniority')}, 'pleno') THEN 'Pleno'
  WHEN regexp_matches({_low('seniority')}, 's[eê]nior') THEN 'Sênior'
  WHEN regexp_matches({_low('seniority')}, 'gestor|gerente|head|diretor|coordenador') THEN 'Gestão'
  WHEN coalesce(seniority, '') = '' THEN 'Não informado' ELSE {_initcap('seniority')} END""",
    "salary_midpoint": "CAST(CASE "
    + _low("salary_band")
    + " ".join(f" WHEN '{band}' THEN {midpoint}" for band, midpoint in SALARY_MIDPOINTS.items())
    + " END AS DOUBLE)",
    "is_employed": f"""CAST(regexp_matches({_low('work_status')},
  'empregado \\(clt\\)|empreendedor ou empregado \\(cnpj\\)|servidor p[uú]blico|freelancer'
  || '|vivo no brasil e trabalho remoto para empresa de fora do brasil'
  || '|vivo fora do brasil e trabalho para empresa de fora do brasil'
  || '|trabalho na área acadêmica/pesquisador|trabalho na area academica/pesquisador') AS INT)""",
    "uses_genai": """CAST(CASE
  WHEN coalesce(genai_free, genai_paid_self, genai_paid_company, genai_copilot, genai_not_used) IS NULL
       AND genai_use_text IS NULL THEN NULL
  WHEN greatest(genai_free, genai_paid_self, genai_paid_company, genai_copilot) = 1 THEN 1
  WHEN coalesce(genai_use_text, '') <> '' AND NOT regexp_matches(lower(genai_use_text), 'n[aã]o utilizo') THEN 1
  ELSE 0 END AS INT)""",
    "region_group": f"""CASE WHEN trim(coalesce(region, '')) = '' THEN 'Não informado' ELSE {_initcap('region')} END""",
}
_ENRICHED = ", ".join(f"{sql} AS {name}" for name, sql in DERIVED.items())

SILVER = f"""respondents AS ({_orders(RESPONDENTS)}),
inputs AS (SELECT resp_id, {_inputs(_RAW_FIELDS)} FROM respondents),
silver AS (SELECT *, {_ENRICHED} FROM inputs)"""

_TECH = " UNION ALL ".join(
    f"SELECT survey_year, round(avg({tool}) * 100, 1) AS adoption_pct, count(*) AS n, '{label}' AS technology "
    "FROM employed WHERE uses_python IS NOT NULL OR uses_sql IS NOT NULL GROUP BY survey_year"
    for tool, label in TOOLS.items()
)

GOLD = {
    "overview": """SELECT survey_year, edition, count(*) AS respondents, CAST(sum(is_employed) AS BIGINT) AS employed,
  round(avg(CASE WHEN gender_group = 'Feminino' THEN 1 ELSE 0 END) * 100, 1) AS pct_women,
  round(avg(CASE WHEN work_model_group = 'Remoto' THEN 1 ELSE 0 END) * 100, 1) AS pct_remote,
  round(avg(salary_midpoint), 0) AS avg_salary_midpoint, round(avg(uses_python) * 100, 1) AS pct_python,
  round(avg(uses_sql) * 100, 1) AS pct_sql, round(avg(uses_aws) * 100, 1) AS pct_aws,
  round(avg(uses_genai) * 100, 1) AS pct_genai
FROM silver GROUP BY survey_year, edition""",
    "market_structure": """SELECT survey_year, job_family, professionals,
  round(professionals / sum(professionals) OVER (PARTITION BY survey_year) * 100, 1) AS share_pct
FROM (SELECT survey_year, job_family, count(*) AS professionals FROM employed GROUP BY survey_year, job_family)""",
    "salary_role_seniority": """SELECT survey_year, job_family, seniority_group, count(*) AS n,
  round(avg(salary_midpoint), 0) AS avg_salary
FROM employed WHERE salary_midpoint IS NOT NULL GROUP BY survey_year, job_family, seniority_group HAVING count(*) >= 20""",
    "gender": """SELECT survey_year, gender_group, job_family, seniority_group, count(*) AS n,
  round(avg(salary_midpoint), 0) AS avg_salary
FROM silver GROUP BY survey_year, gender_group, job_family, seniority_group""",
    "gender_gap": """SELECT survey_year, gender_group, count(*) AS n, round(avg(salary_midpoint), 0) AS avg_salary,
  round(avg(CASE WHEN seniority_group = 'Sênior' THEN 1 ELSE 0 END) * 100, 1) AS pct_senior
FROM employed WHERE gender_group IN ('Feminino', 'Masculino') GROUP BY survey_year, gender_group""",
    "tech_adoption": _TECH,
    "region_work_model": """SELECT survey_year, region_group, work_model_group, count(*) AS n,
  round(avg(salary_midpoint), 0) AS avg_salary FROM employed GROUP BY survey_year, region_group, work_model_group""",
    "ai_adoption": """SELECT survey_year, job_family, seniority_group, count(*) AS n,
  round(avg(uses_genai) * 100, 1) AS pct_uses_genai, round(avg(salary_midpoint), 0) AS avg_salary
FROM silver WHERE uses_genai IS NOT NULL GROUP BY survey_year, job_family, seniority_group HAVING count(*) >= 15""",
    "sector": """SELECT survey_year, sector, count(*) AS n, round(avg(salary_midpoint), 0) AS avg_salary
FROM employed GROUP BY survey_year, sector HAVING count(*) >= 30""",
}


GOLD_MEASURES = {
    "overview": ("respondents", "employed", "pct_women", "pct_remote", "avg_salary_midpoint", "pct_python", "pct_sql",
                 "pct_aws", "pct_genai"),
    "market_structure": ("professionals", "share_pct"),
    "salary_role_seniority": ("n", "avg_salary"),
    "gender": ("n", "avg_salary"),
    "gender_gap": ("n", "avg_salary", "pct_senior"),
    "tech_adoption": ("adoption_pct", "n"),
    "region_work_model": ("n", "avg_salary"),
    "ai_adoption": ("n", "pct_uses_genai", "avg_salary"),
    "sector": ("n", "avg_salary"),
}

#: The order that a query's rows have, as an ORDER BY on its oracle.
ORDERS = {
    "overview": "survey_year",
    "market_structure": "survey_year, professionals DESC",
    "salary_role_seniority": "survey_year, job_family, seniority_group",
    "gender": "survey_year, gender_group",
    "tech_adoption": "survey_year, adoption_pct DESC NULLS LAST",
    "region_work_model": "survey_year, region_group",
    "sector": "survey_year, n DESC",
    "q_overview": "survey_year",
    "q_market_2025": "professionals DESC",
    "q_market_trend": "job_family, survey_year",
    "q_salary_senior": "avg_salary DESC",
    "q_salary_ladder": "job_family, seniority_group",
    "q_salary_staff": "avg_salary DESC",
    "q_gender": "survey_year, gender_group",
    "q_tech_2025": "adoption_pct DESC NULLS LAST",
    "q_tech_trend": "technology, survey_year",
    "q_genai_by_family": "pct_genai DESC",
    "q_region": "n DESC",
    "q_work_model": "n DESC",
    "q_work_model_salary": "salario DESC",
    "q_region_sudeste": "n DESC",
    "q_top_sectors": "n DESC, sector",
    "tech_2025": "adoption_pct DESC NULLS LAST",
    "market_2025_asc": "professionals",
    "senior_salary_asc": "avg_salary",
    "tech_2025_asc": "adoption_pct NULLS LAST",
    "silver_counts": "survey_year",
}


def silver(query: str) -> str:
    return f"WITH {SILVER}\n{query}"


_EMPLOYED = "employed AS (SELECT * FROM silver WHERE is_employed = 1)"


def gold(table: str, query: str | None = None) -> str:
    return f"WITH {SILVER},\n{_EMPLOYED},\n{table} AS ({GOLD[table]})\n{query or f'SELECT * FROM {table}'}"


def gold_contents(respondents: str) -> str:
    """All gold tables as (gold_table, row, measure, value)."""
    parts = []
    for name, keys in GOLD_KEYS.items():
        row = ", ".join(f"CAST({key} AS VARCHAR)" for key in keys)
        measures = [m for m in GOLD_MEASURES[name]]
        values = ", ".join(f"CAST({m} AS DOUBLE)" for m in measures)
        parts.append(
            f"SELECT '{name}' AS gold_table, concat_ws('|', {row}) AS \"row\", unnest([{_strings(measures)}]) AS measure, "
            f"unnest([{values}]) AS \"value\" FROM ({GOLD[name]}) t"
        )
    return f"WITH {respondents},\n{_EMPLOYED}\n" + " UNION ALL ".join(parts)


NAMES = f"""headers AS ({_orders(HEADER_CATALOG)}),
names AS (SELECT *, trim(regexp_replace(strip_accents(lower(header)), '[^a-z0-9.]+', ' ', 'g')) AS name FROM headers)"""


def _rule_rows(rules) -> str:
    def words(values) -> str:
        return f"CAST([{_strings(values)}] AS VARCHAR[])"

    return ", ".join(
        f"('{field}', {step}, {words(include)}, {words(exclude)}, {str(shortest).lower()})"
        for field, steps, shortest in rules
        for step, (include, exclude) in enumerate(steps)
    )


def headers(rules, powerbi: bool = False) -> str:
    """Best header per edition and field: rules x headers, ranked by a window."""
    hit = (
        "CASE WHEN t = '' THEN true WHEN regexp_matches(t, '[ .]') THEN contains(name, t) "
        "ELSE list_contains(string_split(name, ' '), t) END"
    )
    fields = [field for field, _, _ in rules]
    parts = []
    if rules:
        parts.append(
            f"""SELECT survey_year, field, step, CASE WHEN shortest THEN length(name) ELSE 0 END AS a,
  CASE WHEN shortest THEN length(header) ELSE 0 END AS b, pos, header
FROM names, (VALUES {_rule_rows(rules)}) rules(field, step, inc, exc, shortest)
WHERE len(list_filter(inc, lambda t: {hit})) = len(inc) AND len(list_filter(exc, lambda t: {hit})) = 0"""
        )
    if powerbi:
        fields.append("uses_powerbi")
        parts.append(
            """SELECT survey_year, 'uses_powerbi' AS field,
  CASE WHEN regexp_matches(name, '^4\\.[jg]\\.1 |p4 [jig] 1 ') THEN 0 ELSE 1 END AS step, 0 AS a, 0 AS b, pos, header
FROM names WHERE contains(replace(name, ' ', ''), 'powerbi') AND NOT regexp_matches(name, 'dashboard|ferramenta')"""
        )
    wanted = ", ".join(f"('{field}')" for field in fields)
    return f"""WITH {NAMES},
hits AS ({' UNION ALL '.join(parts)}),
best AS (SELECT *, row_number() OVER (PARTITION BY survey_year, field ORDER BY step, a, b, pos) AS place FROM hits)
SELECT e.survey_year, f.field, best.header AS source_header, CAST(best.pos AS INT) AS pos
FROM (SELECT DISTINCT survey_year FROM headers) e CROSS JOIN (VALUES {wanted}) f(field)
LEFT JOIN best ON best.survey_year = e.survey_year AND best.field = f.field AND best.place = 1"""


_PIPELINE_FIELDS = set(EDITION_HEADERS[2023]) | {"edition", "uses_snowflake"}
PIPELINE = f"""answers AS ({_orders(RAW_ANSWERS)}),
inputs AS (SELECT {_inputs(_PIPELINE_FIELDS, nulls=True)} FROM answers),
silver AS (SELECT *, {_ENRICHED} FROM inputs)"""

_FOLDED = "coalesce(regexp_replace(strip_accents(lower(text)), '^\\s+|\\s+$', '', 'g'), '')"
_HEADER_TEXT = "trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9.]+', ' ', 'g'))"
# Lines of two editions, the cells after the third in a list; a header has three columns or four.
_LINES = """SELECT *, 3 + len(extra) AS n_cells, CASE survey_year WHEN 2023 THEN 3 ELSE 4 END AS width,
  concat_ws(',', o_orderkey, '"' || o_orderpriority || ', ' || o_orderstatus || '"', o_custkey) ||
    CASE o_orderkey % 16 WHEN 0 THEN ',more' WHEN 1 THEN ',' WHEN 2 THEN ',,x' WHEN 3 THEN ',"a,b"' WHEN 4 THEN ',' WHEN 6 THEN ',,' ELSE '' END AS line
FROM (SELECT *, CAST(2024 - o_orderkey % 2 AS INT) AS survey_year,
  CASE o_orderkey % 16 WHEN 0 THEN ['more'] WHEN 1 THEN [''] WHEN 2 THEN ['', 'x'] WHEN 3 THEN ['a,b'] WHEN 4 THEN [''] WHEN 6 THEN ['', ''] ELSE [] END AS extra FROM orders) o"""

_SPANNING = "SELECT * REPLACE (replace(text, '. ', '.' || chr(10) || ' ' || chr(10)) AS text) FROM documents"
_CELL = f"CASE WHEN {{0}} NOT IN ({_strings(NULL_TOKENS)}) THEN {{0}} END"
_MAPPING = ", ".join(
    f"({year}, '{field}', '" + header.replace("'", "''") + "')"
    for year, fields in EDITION_HEADERS.items()
    for field, header in fields.items()
)


def _words(field: str):
    return (field, HEADER_RULES[field], True)


def oracles() -> dict[str, str]:
    sql = {
        "scan_csv_edition": f"""SELECT CAST(doc_id AS VARCHAR) AS c0, {_CELL.format('text')} AS c1,
  {_CELL.format('lang')} AS c2, {_CELL.format('source')} AS c3, CAST(n_chars AS VARCHAR) AS c4 FROM documents""",
        "null_tokens": f"SELECT o_orderkey, {_CELL.format('cell')} AS cell FROM ({_orders(CELLS)}) c",
        "edition_registry": f"""WITH respondents AS ({_orders(RESPONDENTS)})
SELECT survey_year, edition, count(*) AS respondents FROM respondents
WHERE survey_year IN (2023, 2024, 2025) GROUP BY ALL""",
        "edition_retention": """SELECT o_orderkey, o_orderstatus, CAST(2021 + o_orderkey % 6 AS INT) AS survey_year
FROM orders WHERE o_orderkey % 6 BETWEEN 2 AND 4""",
        "land_edition": """SELECT CAST(o_orderkey AS VARCHAR) AS c0, CAST(o_custkey AS VARCHAR) AS c1, o_orderpriority AS c2,
  CAST(2023 AS INT) AS survey_year FROM orders""",
        "silver_schema_contract": f"WITH {SILVER} SELECT * FROM inputs",
        "silver_enriched": silver("SELECT * FROM silver"),
        "silver_roundtrip": silver("SELECT * EXCLUDE (resp_id) FROM silver"),
        "silver_counts": silver('SELECT survey_year, count(*) AS "count" FROM silver GROUP BY survey_year'),
        "silver_pipeline": f"WITH {PIPELINE} SELECT * FROM silver",
        "harmonise_edition": f"WITH {PIPELINE} SELECT * FROM inputs WHERE survey_year = 2025",
        "union_editions": f"WITH {PIPELINE} SELECT * FROM inputs",
        "filter_employed": silver("SELECT resp_id, survey_year, job_family FROM silver WHERE is_employed = 1"),
        "to_flag": f"WITH {SILVER} SELECT resp_id, {', '.join(FLAG_FIELDS)} FROM inputs",
        "normalize_text": f"SELECT doc_id, {_HEADER_TEXT} AS norm FROM documents",
        "fold_text": f"SELECT doc_id, {_FOLDED} AS folded FROM documents",
        "has_token": f"""SELECT doc_id, regexp_matches(norm, '(^| )der( |$)') AS has_word,
  contains(norm, 'of the') AS has_phrase, contains(norm, 'tion.') AS has_dotted, true AS has_nothing
FROM (SELECT doc_id, {_HEADER_TEXT} AS norm FROM documents)""",
        "find_column": headers([("column", ((("nivel",), ("ensino", "cobranca", "vagas")),), True)]),
        "find_column_unranked": headers([("column", ((("sql",), ()),), False)]),
        "find_column_chain": headers(
            [_words(field) for field in ("work_model", "uses_sql", "is_manager", "genai_not_used",
                                         "genai_paid_self", "company_genai_priority")]
        ),
        "find_column_ranked": headers([], powerbi=True),
        "resolve_schema": headers([_words(field) for field in HEADER_RULES], powerbi=True),
        "resolve_rules": headers([_words(field) for field in HEADER_RULES], powerbi=True),
        "mapping_report": f"""WITH present AS (SELECT DISTINCT survey_year, edition FROM ({_orders(RESPONDENTS)}) r),
fields AS (SELECT unnest([{_strings(INPUT_FIELDS[2:])}]) AS field)
SELECT p.survey_year, p.edition, f.field, m.source_header FROM present p CROSS JOIN fields f
LEFT JOIN (VALUES {_MAPPING}) m(survey_year, field, source_header)
  ON m.survey_year = p.survey_year AND m.field = f.field""",
        "share_of_total": """SELECT y, l_returnflag, n, round(n / sum(n) OVER (PARTITION BY y) * 100, 1) AS share_pct
FROM (SELECT CAST(year(l_shipdate) AS INT) AS y, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
        "avg_round0": """SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 0) AS avg_price
FROM orders GROUP BY 1""",
        "pct_flag_nonnull": """SELECT source, round(avg(CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 2 END) * 100, 1) AS pct
FROM documents GROUP BY 1""",
        "pct_condition_all": """SELECT user_id, count(*) AS n,
  round(avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 100, 1) AS pct_error FROM events GROUP BY 1""",
        "having_min_n": """SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2
HAVING count(*) >= 12""",
        "weighted_mean": """SELECT o_orderstatus, round(sum(a * n) / sum(n), 1) AS wmean, CAST(sum(n) AS BIGINT) AS n
FROM (SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 0) AS a, count(*) AS n FROM orders GROUP BY 1, 2)
GROUP BY 1""",
        "scalar_text": """SELECT p_partkey, lower(p_type) AS lo, CAST(length(p_name) AS INT) AS len,
  contains(p_name, 'ring') AS has_ring, regexp_matches(p_name, 'red|blue') AS color,
  trim('  ' || p_name || ' ') AS trimmed,
  array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS capital
FROM part""",
        "scalar_round": """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 0) AS net
FROM lineitem""",
        "gold_all": gold_contents(SILVER),
        "run_job": gold_contents(PIPELINE),
        "gold_updated": gold_contents(SILVER),
        "job_gold": gold_contents(SILVER),
        "job_silver": f"WITH {PIPELINE} SELECT * FROM silver",
        "land_changed": """SELECT CASE o_orderkey % 3 WHEN 1 THEN 2023 WHEN 2 THEN 2024 ELSE 2025 END::INTEGER AS survey_year,
  CAST(o_orderkey AS VARCHAR) AS c0, CAST(o_custkey AS VARCHAR) AS c1, o_orderpriority AS c2
FROM orders WHERE o_orderkey % 3 <> 2 OR o_orderkey % 6 = 2""",
        "contract_violations": f"""WITH {PIPELINE} SELECT count(*) AS n_rows, 0::BIGINT AS null_years, 0::BIGINT AS bad_flags,
  count(*) FILTER (salary_band IS NOT NULL AND salary_midpoint IS NULL) AS unknown_bands FROM silver""",
        "silver_in_catalog": silver("""SELECT survey_year, count(*) AS n, sum(is_employed)::BIGINT AS employed FROM (
  SELECT * REPLACE (CASE WHEN gender IS NULL THEN survey_year - 2 ELSE survey_year END::INTEGER AS survey_year) FROM silver) s
WHERE survey_year BETWEEN 2023 AND 2025 GROUP BY survey_year"""),
        "pick_largest_file": """SELECT year, length FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year,
  CAST(sum(strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus)) + 1) AS BIGINT) AS length FROM orders GROUP BY 1)
ORDER BY length DESC, year LIMIT 1""",
        "scan_csv_spanning": f"""SELECT CAST(doc_id AS VARCHAR) AS c0, {_CELL.format('text')} AS c1,
  {_CELL.format('lang')} AS c2, {_CELL.format('source')} AS c3, CAST(n_chars AS VARCHAR) AS c4 FROM ({_SPANNING}) d""",
        "scan_csv_irregular": f"""SELECT CAST(doc_id AS VARCHAR) AS c0, {_CELL.format('text')} AS c1,
  lang || ' 5" tela' AS c2, source || 's' AS c3 FROM ({_SPANNING}) d""",
        "scan_csv_rejects": f"""SELECT survey_year, o_orderkey, line AS record,
  'a record has ' || n_cells || ' cells, the header has ' || width AS reason FROM ({_LINES}) l WHERE n_cells > width""",
        "scan_csv_accepted": f"""SELECT survey_year, CAST(o_orderkey AS VARCHAR) AS c0, o_orderpriority || ', ' || o_orderstatus AS c1,
  CAST(o_custkey AS VARCHAR) AS c2, nullif(extra[1], '') AS c3 FROM ({_LINES}) l WHERE n_cells <= width""",
        "gold_roundtrip": gold("region_work_model"),
        "gold_csv_roundtrip": gold("sector"),
        "q_overview": gold("overview"),
        "q_market_2025": gold("market_structure", "SELECT * FROM market_structure WHERE survey_year = 2025"),
        "q_market_trend": gold(
            "market_structure",
            "SELECT survey_year, job_family, share_pct FROM market_structure WHERE job_family IN "
            "('Analista de BI', 'Analytics Engineer', 'Engenheiro de ML/IA', 'Gestão')",
        ),
        "q_salary_senior": gold(
            "salary_role_seniority",
            "SELECT job_family, avg_salary, n FROM salary_role_seniority WHERE seniority_group = 'Sênior' AND survey_year = 2025",
        ),
        "q_salary_ladder": gold(
            "salary_role_seniority",
            "SELECT job_family, seniority_group, n, avg_salary FROM salary_role_seniority WHERE survey_year = 2025 "
            "AND regexp_matches(job_family, '^(Analista de Dados|Engenharia de Dados|Cientista de Dados)$') "
            "AND regexp_matches(seniority_group, '^(Júnior|Pleno|Sênior)$')",
        ),
        "q_salary_staff": gold(
            "salary_role_seniority",
            "SELECT job_family, n, avg_salary FROM salary_role_seniority "
            "WHERE seniority_group = 'Especialista/staff+' AND survey_year = 2025",
        ),
        "q_gender": gold("gender_gap"),
        "q_gender_pivot": gold(
            "gender_gap",
            "SELECT f.n AS n_f, m.n AS n_m, f.avg_salary AS salario_f, m.avg_salary AS salario_m, "
            "f.pct_senior AS senior_f, m.pct_senior AS senior_m FROM gender_gap f JOIN gender_gap m USING (survey_year) "
            "WHERE survey_year = 2025 AND f.gender_group = 'Feminino' AND m.gender_group = 'Masculino'",
        ),
        "q_tech_2025": gold(
            "tech_adoption", "SELECT technology, adoption_pct, n FROM tech_adoption WHERE survey_year = 2025"
        ),
        "q_tech_trend": gold(
            "tech_adoption",
            "SELECT survey_year, technology, adoption_pct FROM tech_adoption WHERE technology NOT IN ('GCP', 'Snowflake')",
        ),
        "q_genai_by_family": gold(
            "ai_adoption",
            "SELECT job_family, round(sum(pct_uses_genai * n) / sum(n), 1) AS pct_genai, CAST(sum(n) AS BIGINT) AS n "
            "FROM ai_adoption WHERE survey_year = 2025 GROUP BY job_family",
        ),
        "q_region": gold(
            "region_work_model",
            "SELECT region_group, CAST(sum(n) AS BIGINT) AS n FROM region_work_model WHERE survey_year = 2025 GROUP BY 1",
        ),
        "q_work_model": gold(
            "region_work_model",
            "SELECT work_model_group, CAST(sum(n) AS BIGINT) AS n FROM region_work_model WHERE survey_year = 2025 GROUP BY 1",
        ),
        "q_work_model_salary": gold(
            "region_work_model",
            "SELECT work_model_group, CAST(sum(n) AS BIGINT) AS n, round(sum(avg_salary * n) / sum(n), 0) AS salario "
            "FROM region_work_model WHERE avg_salary IS NOT NULL AND survey_year = 2025 GROUP BY 1",
        ),
        "q_region_sudeste": gold(
            "region_work_model",
            "SELECT work_model_group, n, avg_salary FROM region_work_model "
            "WHERE region_group = 'Sudeste' AND survey_year = 2025",
        ),
        "q_top_sectors": gold(
            "sector",
            "SELECT sector, n, avg_salary FROM sector WHERE survey_year = 2025 AND coalesce(trim(sector), '') <> '' "
            "ORDER BY n DESC, sector LIMIT 10",
        ),
        "tech_2025": gold("tech_adoption", "SELECT * FROM tech_adoption WHERE survey_year = 2025"),
        "tech_2025_asc": gold("tech_adoption", "SELECT * FROM tech_adoption WHERE survey_year = 2025"),
        "market_2025_asc": gold("market_structure", "SELECT * FROM market_structure WHERE survey_year = 2025"),
        "senior_salary_asc": gold(
            "salary_role_seniority",
            "SELECT * FROM salary_role_seniority WHERE survey_year = 2025 AND seniority_group = 'Sênior'",
        ),
        "gender_2025": gold("gender", "SELECT * FROM gender WHERE survey_year = 2025"),
    }
    for name in GOLD:
        sql[name] = gold(name)
    for name in STATEMENTS:
        sql[f"sql_{name}"] = sql[name]
    for name in DERIVED:
        sql[name] = silver(f"SELECT resp_id, {name} FROM silver")
    return sql
