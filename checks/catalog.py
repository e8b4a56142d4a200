"""The registered queries: (spark, sf_dir) -> DataFrame, one per operator of the inventory."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks.fixture import (
    CELLS,
    HEADER_CATALOG,
    RESPONDENTS,
    from_orders,
    respondents,
    table,
    work_folder,
    write_bronze,
    write_csv,
)
from surveymill.fixed_values import EDITIONS, FLAG_FIELDS, HEADER_RULES
from surveymill.functions import measures
from surveymill.functions.text import fold_text, has_token, header_name, null_tokens
from surveymill.operators import headers
from surveymill.operators.respondents import DERIVATIONS, enrich
from surveymill import jobs
from surveymill.plans import analyses, cells, gold, silver, statements
from surveymill.session import tune
from surveymill.sources import editions, lake, landing, survey_csv
from surveymill.sources.editions import edition_path

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return enrich(respondents(spark, sf_dir, *extra))


def _gold(name: str) -> Query:
    make = gold.GOLD_TABLES[name][0]
    return lambda spark, sf_dir: make(cells.units(_silver(spark, sf_dir)))


def _analysis(name: str) -> Query:
    question, table_name = analyses.ANALYSES[name]
    return lambda spark, sf_dir: question(_gold(table_name)(spark, sf_dir))


def _statement(name: str) -> Query:
    table_name = analyses.ANALYSES[name][1]

    def query(spark, sf_dir):
        return statements.ask(spark, name, {table_name: _gold(table_name)(spark, sf_dir)})

    return query


def _derived(name: str) -> Query:
    return lambda spark, sf_dir: enrich(respondents(spark, sf_dir, "resp_id"), [name]).select("resp_id", name)


# --- sources and sinks -----------------------------------------------------------------------


def scan_csv_edition(spark, sf_dir):
    path = f"{work_folder(spark)}/survey.csv"
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"), path)
    return survey_csv.clean(survey_csv.scan_edition(spark, path).rows)


def _spanning_text(spark, sf_dir):
    """Documents with more line breaks than there are, and lines of a blank in between."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumn("text", F.regexp_replace("text", "[.] ", ".\n \n"))


def _write_lines(lines, header, path):
    """Text as CSV files as they are, each with a header of its own."""

    def with_header(batches):
        for n, batch in enumerate(batches):
            if not n:
                yield pa.RecordBatch.from_pydict({"value": [header]}, schema=batch.schema)
            yield batch

    as_is = dict(sep="\x01", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    whole = lines.mapInArrow(with_header, "value string")
    whole.select(F.explode(F.split("value", "\n"))).write.options(**as_is).csv(path)


def scan_csv_spanning(spark, sf_dir):
    """Records that span lines, in several files."""
    path = f"{work_folder(spark)}/survey.csv"
    write_csv(_spanning_text(spark, sf_dir).repartitionByRange("doc_id"), path)
    return survey_csv.clean(survey_csv.scan_edition(spark, path).rows)


def scan_csv_irregular(spark, sf_dir):
    """Quotes that open nothing or close before a cell's end, beside records that span lines, in several files."""
    path = f"{work_folder(spark)}/survey.csv"
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", "doc_id", quoted, F.concat("lang", F.lit(' 5" tela')), F.concat(F.lit('"'), "source", F.lit('"s')))
    records = _spanning_text(spark, sf_dir).repartitionByRange("doc_id").select(line.alias("value"))
    _write_lines(records, "doc_id,text,lang,source", path)
    return survey_csv.clean(survey_csv.scan_edition(spark, path, close_quotes=True).rows)


def _rejected(spark, sf_dir):
    """Orders as CSV lines of two editions, of which some records have more cells than their header."""
    path = f"{work_folder(spark)}/bronze"
    extra = """CASE o_orderkey % 16 WHEN 0 THEN ',more' WHEN 1 THEN ',' WHEN 2 THEN ',,x' WHEN 3 THEN ',"a,b"' WHEN 4 THEN ',' WHEN 6 THEN ',,' ELSE '' END"""
    line = f"""concat(o_orderkey, ',"', o_orderpriority, ', ', o_orderstatus, '",', o_custkey, {extra})"""
    lines = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{line} AS value")
    for year, header in ((2023, "key,priority,customer"), (2024, "key,priority,customer,more")):
        own = lines.filter(F.col("o_orderkey") % 2 == year % 2).repartitionByRange("o_orderkey").select("value")
        _write_lines(own, header, edition_path(path, year))
    return survey_csv.scan_editions(spark, {year: edition_path(path, year) for year in (2023, 2024)}, rejects=True)


def scan_csv_rejects(spark, sf_dir):
    """The records with more cells than their header, and how many they have."""
    rejects = _rejected(spark, sf_dir).rejects
    return rejects.select("survey_year", F.substring_index("record", ",", 1).cast("long").alias("o_orderkey"), "record", "reason")


def scan_csv_accepted(spark, sf_dir):
    """The rows beside them."""
    return _rejected(spark, sf_dir).rows


def null_cells(spark, sf_dir):
    return from_orders(spark, sf_dir, CELLS).selectExpr("o_orderkey", f"{null_tokens('cell')} AS cell")


def edition_registry(spark, sf_dir):
    """Respondents per registered edition; the registry has one row per edition."""
    years = from_orders(spark, sf_dir, RESPONDENTS).groupBy("survey_year").agg(F.count("*").alias("respondents"))
    return years.join(F.broadcast(editions.registry(spark)), "survey_year").select(
        "survey_year", "edition", "respondents"
    )


def edition_retention(spark, sf_dir):
    path = f"{work_folder(spark)}/bronze"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", (2021 + F.col("o_orderkey") % 6).cast("int").alias("survey_year")
    )
    orders.write.partitionBy("survey_year").parquet(path)
    return editions.retain_registered(spark.read.parquet(path))


def pick_largest_file(spark, sf_dir):
    """The largest CSV of a folder of orders by year, with its size."""
    path = f"{work_folder(spark)}/download"
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "year")
    orders.repartition("year").write.partitionBy("year").csv(path)  # one file a year
    largest = landing.pick_largest(spark, path)
    files = survey_csv.csv_files(spark, path)
    return files.filter(F.col("path") == largest).select(
        F.regexp_extract("path", r"year=(\d+)", 1).alias("year"), "length"
    )


def land_edition(spark, sf_dir):
    work = work_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    write_csv(orders, f"{work}/download")
    landing.land_edition(spark, f"{work}/download", f"{work}/bronze", 2023)
    return spark.read.parquet(f"{work}/bronze")


def silver_roundtrip(spark, sf_dir):
    path = f"{work_folder(spark)}/professionals"
    lake.write_silver(_silver(spark, sf_dir), path)
    return lake.read_silver(spark, path)


def gold_roundtrip(spark, sf_dir):
    path = f"{work_folder(spark)}/region_work_model"
    lake.write_gold(_gold("region_work_model")(spark, sf_dir), path)
    return spark.read.parquet(path)


def gold_csv_roundtrip(spark, sf_dir):
    path = f"{work_folder(spark)}/sector"
    sectors = _gold("sector")(spark, sf_dir)
    lake.write_gold_csv(sectors, path)
    return lake.read_gold_csv(spark, path, sectors.schema)


# --- headers and harmonisation ---------------------------------------------------------------


def _headers(spark, sf_dir):
    return from_orders(spark, sf_dir, HEADER_CATALOG)


def find_column(spark, sf_dir):
    return headers.find_column(_headers(spark, sf_dir), ["Nível"], ["ensino", "cobranca", "vagas"])


def find_column_unranked(spark, sf_dir):
    return headers.find_column(_headers(spark, sf_dir), ["sql"], prefer_shortest=False)


def find_column_chain(spark, sf_dir):
    chained = {field: headers.chain(steps) for field, steps in HEADER_RULES.items() if len(steps) > 1}
    return headers.best_headers(_headers(spark, sf_dir), chained)


def find_column_ranked(spark, sf_dir):
    return headers.find_powerbi(_headers(spark, sf_dir))


def resolve_schema(spark, sf_dir):
    return headers.resolve_schema(_headers(spark, sf_dir))


def resolve_rules(spark, sf_dir):
    """The canonical fields by a table of rules."""
    catalog = _headers(spark, sf_dir)
    by_words = {field: HEADER_RULES[field] for field in headers.RESOLVED_FIELDS if field != "uses_powerbi"}
    found = headers.resolve_by_rules(catalog, headers.rules_table(spark, by_words))
    return found.unionByName(headers.find_powerbi(catalog))


def _bronze(spark, sf_dir):
    path = f"{work_folder(spark)}/bronze"
    write_bronze(spark, sf_dir, path)
    return path


def mapping_report(spark, sf_dir):
    return silver.mapping_report(spark, silver.open_editions(spark, _bronze(spark, sf_dir)))


def _harmonised(spark, sf_dir, registered):
    return silver.harmonised(spark, silver.open_editions(spark, _bronze(spark, sf_dir), registered), registered)


def harmonise_edition(spark, sf_dir):
    return _harmonised(spark, sf_dir, {2025: EDITIONS[2025]})


def all_editions(spark, sf_dir):
    return _harmonised(spark, sf_dir, EDITIONS)


def silver_pipeline(spark, sf_dir):
    """Landed CSV editions to the written respondent table."""
    bronze = _bronze(spark, sf_dir)
    return silver.build_silver(spark, bronze, f"{work_folder(spark)}/professionals")


#: The columns that make a row of a gold table; the others are its measures.
GOLD_KEYS = {
    "overview": ("survey_year", "edition"),
    "market_structure": ("survey_year", "job_family"),
    "salary_role_seniority": ("survey_year", "job_family", "seniority_group"),
    "gender": ("survey_year", "gender_group", "job_family", "seniority_group"),
    "gender_gap": ("survey_year", "gender_group"),
    "tech_adoption": ("survey_year", "technology"),
    "region_work_model": ("survey_year", "region_group", "work_model_group"),
    "ai_adoption": ("survey_year", "job_family", "seniority_group"),
    "sector": ("survey_year", "sector"),
}


def long_form(tables):
    """The contents of gold tables as ``(gold_table, row, measure, value)``."""
    parts = []
    for name, keys in GOLD_KEYS.items():
        measures = [column for column in tables[name].columns if column not in keys]
        values = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
        rows = tables[name].select(F.concat_ws("|", *keys).alias("row"), F.explode(F.array(*values)).alias("v"))
        parts.append(rows.select(F.lit(name).alias("gold_table"), "row", "v.measure", "v.value"))
    return reduce(DataFrame.unionByName, parts)


def gold_all(spark, sf_dir):
    """Builds all nine tables from a written respondent table; returns what they hold."""
    work = work_folder(spark)
    lake.write_silver(_silver(spark, sf_dir), f"{work}/professionals")
    return long_form(gold.build_gold(spark, f"{work}/professionals", f"{work}/gold"))


def gold_updated(spark, sf_dir):
    """Gold tables after one edition has changed: built from a part of its rows first, then brought up to date for its year."""
    work, complete = work_folder(spark), _silver(spark, sf_dir)
    part = complete.filter("survey_year <> 2024 OR job_title IS NULL")
    lake.write_silver(part, f"{work}/professionals")
    gold.update_gold(spark, f"{work}/professionals", f"{work}/gold", EDITIONS)
    lake.write_silver(complete.filter("survey_year = 2024"), f"{work}/professionals", editions_only=True)
    return long_form(gold.update_gold(spark, f"{work}/professionals", f"{work}/gold", [2024]))


def land_changed(spark, sf_dir):
    """Downloads landed, one of them replaced by a smaller file, and landed again: what the bronze layer holds, and from which run."""
    work = work_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folders = {year: f"{work}/download/{year}" for year in EDITIONS}
    for year, folder in folders.items():
        write_csv(orders.filter(F.col("o_orderkey") % 3 == year % 3).coalesce(1), folder)
    landing.land_downloads(spark, folders, f"{work}/bronze")
    folders[2024] = f"{work}/download/2024-again"
    write_csv(orders.filter(F.col("o_orderkey") % 6 == 2024 % 6).coalesce(1), folders[2024])
    landing.land_downloads(spark, folders, f"{work}/bronze")
    opened = landing.read_landed_editions(spark, f"{work}/bronze", list(EDITIONS))
    return opened.rows.select("survey_year", "c0", "c1", "c2")


def contract_violations(spark, sf_dir):
    """Counts of contract violations, taken as the respondent table is written."""
    observed = Observation("contract")
    silver.build_silver(spark, _bronze(spark, sf_dir), f"{work_folder(spark)}/professionals", observed=observed)
    counts = observed.get
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def silver_in_catalog(spark, sf_dir):
    """Respondents of five years in a catalog table of the registered ones, counted by SQL."""
    path, database = f"{work_folder(spark)}/professionals", f"survey_{uuid.uuid4().hex}"
    years = _silver(spark, sf_dir).withColumn("survey_year", F.when(F.col("gender").isNull(), F.col("survey_year") - 2).otherwise(F.col("survey_year")))
    lake.write_silver(years, path)
    lake.register_silver(spark, database, path)
    return spark.sql(f"SELECT survey_year, count(*) AS n, sum(is_employed) AS employed FROM {database}.professionals GROUP BY survey_year")


def job_silver(spark, sf_dir):
    """The silver job by its arguments."""
    work = work_folder(spark)
    write_bronze(spark, sf_dir, f"{work}/bronze")
    jobs.main(["silver", "--JOB_NAME", "silver", "--BRONZE_S3", f"{work}/bronze", "--SILVER_S3", f"{work}/silver"], spark)
    return lake.read_silver(spark, f"{work}/silver/professionals")


def job_gold(spark, sf_dir):
    """The gold job, with its locations from the environment."""
    work, before = work_folder(spark), os.environ.get("LAKE_URI")
    os.environ["LAKE_URI"] = work
    try:
        layers = editions.Locations.from_env()
        lake.write_silver(_silver(spark, sf_dir), layers.respondents)
        jobs.main(["gold"], spark)
    finally:
        os.environ.pop("LAKE_URI")
        if before is not None:
            os.environ["LAKE_URI"] = before
    return long_form(lake.read_gold(spark, layers.gold, GOLD_KEYS))


def run_job(spark, sf_dir):
    """The whole job, from raw editions to the gold tables in the catalog; returns what these hold."""
    work, database = work_folder(spark), f"survey_{uuid.uuid4().hex}"
    write_bronze(spark, sf_dir, f"{work}/bronze")
    layers = editions.Locations(f"{work}/bronze", f"{work}/silver", f"{work}/gold")
    jobs.run(spark, layers, database=database)
    return long_form({name: spark.table(f"{database}.{name}") for name in GOLD_KEYS})


# --- text, rows, aggregates ------------------------------------------------------------------


def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", header_name(F.col("text")).alias("norm"))


def folded_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fold_text(F.col("text")).alias("folded"))


def token_tests(spark, sf_dir):
    tests = {"has_word": "der", "has_phrase": "of the", "has_dotted": "tion.", "has_nothing": ""}
    return normalize_text(spark, sf_dir).selectExpr(
        "doc_id", *[f"{has_token('norm', token)} AS {name}" for name, token in tests.items()]
    )


def to_flag(spark, sf_dir):
    return respondents(spark, sf_dir, "resp_id").select("resp_id", *FLAG_FIELDS)


def filter_employed(spark, sf_dir):
    employed = _silver(spark, sf_dir, "resp_id").filter(F.col("is_employed") == 1)
    return employed.select("resp_id", "survey_year", "job_family")


def silver_counts(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy("survey_year").count().orderBy("survey_year")


def share_of_total(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("y"), "l_returnflag")
    return measures.share_of_total(lines.agg(F.count("*").alias("n")), "n", "y")


def avg_round0(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy("o_orderpriority")
    return orders.agg(F.count("*").alias("n"), measures.mean("o_totalprice").alias("avg_price"))


def pct_flag_nonnull(spark, sf_dir):
    answered = F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 2)
    return table(spark, sf_dir, "documents").groupBy("source").agg(measures.flag_pct(answered).alias("pct"))


def pct_condition_all(spark, sf_dir):
    events = table(spark, sf_dir, "events").groupBy("user_id")
    error = F.col("event_type") == "error"
    return events.agg(F.count("*").alias("n"), measures.condition_pct(error).alias("pct_error"))


def having_min_n(spark, sf_dir):
    groups = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment")
    return groups.agg(F.count("*").alias("n")).filter("n >= 12")


def weighted_mean(spark, sf_dir):
    groups = table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority")
    means = groups.agg(measures.mean("o_totalprice").alias("a"), F.count("*").alias("n"))
    return means.groupBy("o_orderstatus").agg(
        measures.weighted_mean("a", "n", 1).alias("wmean"), F.sum("n").alias("n")
    )


def scalar_text(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower("p_type").alias("lo"),
        F.length(name).alias("len"),
        name.contains("ring").alias("has_ring"),
        name.rlike("red|blue").alias("color"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.initcap("p_type").alias("capital"),
    )


def scalar_round(spark, sf_dir):
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", net.alias("net"))


_QUERIES: dict[str, Query] = {
    "scan_csv_edition": scan_csv_edition,
    "scan_csv_spanning": scan_csv_spanning,
    "scan_csv_irregular": scan_csv_irregular,
    "scan_csv_rejects": scan_csv_rejects,
    "scan_csv_accepted": scan_csv_accepted,
    "null_tokens": null_cells,
    "edition_registry": edition_registry,
    "edition_retention": edition_retention,
    "pick_largest_file": pick_largest_file,
    "land_edition": land_edition,
    "silver_schema_contract": lambda spark, sf_dir: respondents(spark, sf_dir, "resp_id"),
    "silver_roundtrip": silver_roundtrip,
    "gold_roundtrip": gold_roundtrip,
    "gold_csv_roundtrip": gold_csv_roundtrip,
    "normalize_text": normalize_text,
    "fold_text": folded_text,
    "has_token": token_tests,
    "find_column": find_column,
    "find_column_unranked": find_column_unranked,
    "find_column_chain": find_column_chain,
    "find_column_ranked": find_column_ranked,
    "resolve_schema": resolve_schema,
    "resolve_rules": resolve_rules,
    "mapping_report": mapping_report,
    "harmonise_edition": harmonise_edition,
    "to_flag": to_flag,
    **{name: _derived(name) for name in DERIVATIONS},
    "silver_enriched": lambda spark, sf_dir: _silver(spark, sf_dir, "resp_id"),
    "union_editions": all_editions,
    "silver_pipeline": silver_pipeline,
    "silver_counts": silver_counts,
    "filter_employed": filter_employed,
    "having_min_n": having_min_n,
    "avg_round0": avg_round0,
    "pct_flag_nonnull": pct_flag_nonnull,
    "pct_condition_all": pct_condition_all,
    "weighted_mean": weighted_mean,
    "share_of_total": share_of_total,
    "scalar_text": scalar_text,
    "scalar_round": scalar_round,
    **{name: _gold(name) for name in gold.GOLD_TABLES},
    "gold_all": gold_all,
    "gold_updated": gold_updated,
    "land_changed": land_changed,
    "contract_violations": contract_violations,
    "silver_in_catalog": silver_in_catalog,
    "job_silver": job_silver,
    "job_gold": job_gold,
    "run_job": run_job,
    **{name: _analysis(name) for name in analyses.ANALYSES},
    **{f"sql_{name}": _statement(name) for name in statements.STATEMENTS},
}


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


QUERIES: dict[str, Query] = {name: _tuned(query) for name, query in _QUERIES.items()}
