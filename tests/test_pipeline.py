"""Silver and gold builds, the analyses on them, and the command line."""

from __future__ import annotations

import csv
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.fixture import DECOY_HEADERS, EDITION_HEADERS, respondents, work_folder, write_bronze
from surveymill import jobs
from surveymill.fixed_values import EDITIONS, TOOLS
from surveymill.functions.measures import condition_pct, flag_pct, mean, pick, ratio, share_of_total, weighted_mean
from surveymill.operators.respondents import SILVER_COLUMNS, enrich
from surveymill.plans import cells as c
from surveymill.plans.analyses import ANALYSES, analyse
from surveymill.plans.gold import CELL_SETS, GOLD_TABLES, changed_cells, gold_tables, update_gold
from surveymill.plans.silver import build_silver, harmonised, mapping, mapping_report, open_editions
from surveymill.plans.statements import STATEMENTS, ask
from surveymill.sources.editions import Locations, edition_path, registry, retain_registered
from surveymill.sources.lake import read_gold_csv, read_silver, register_silver, register_tables, write_silver
from surveymill.sources.landing import land_edition

SF = "/root/testdata/sf0.001"


def _sorted(frame):
    columns = sorted(frame.columns)
    return sorted(map(repr, frame.select(*columns).collect()))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    write_bronze(spark, SF, f"{root}/bronze")
    layers = Locations(f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    jobs.run(spark, layers, csv=f"{root}/csv")
    return root, layers


def test_silver_schema_and_partitions(spark, lake, tmp_path):
    _, layers = lake
    silver = read_silver(spark, layers.respondents)
    assert tuple(silver.columns) == SILVER_COLUMNS
    assert silver.count() == 1500
    one = silver.filter("survey_year = 2024")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(survey_year" in plan
    assert {r[0] for r in one.select("edition").distinct().collect()} == {EDITIONS[2024]}


def test_silver_from_landed_editions_is_the_same(spark, lake, tmp_path):
    _, layers = lake
    for year in EDITIONS:
        land_edition(spark, edition_path(layers.bronze, year), f"{tmp_path}/landed", year)
    landed = build_silver(spark, f"{tmp_path}/landed", f"{tmp_path}/silver", landed=True)
    assert _sorted(landed) == _sorted(read_silver(spark, layers.respondents))
    catalog = open_editions(spark, f"{tmp_path}/landed", landed=True).catalog.filter("survey_year = 2025").collect()
    assert {r["header"] for r in catalog} == {*EDITION_HEADERS[2025].values(), DECOY_HEADERS[2025]}


def test_run_from_downloads_and_printed_mapping(spark, lake, tmp_path, capsys):
    downloads = {year: edition_path(lake[1].bronze, year) for year in EDITIONS}
    layers = Locations(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold")
    tables = jobs.run(spark, layers, downloads)
    for name, table in tables.items():
        assert _sorted(table) == _sorted(spark.read.parquet(f"{lake[1].gold}/{name}")), name
    jobs.print_mapping(spark, layers.bronze, landed=True)
    printed = capsys.readouterr().out
    assert printed.count("\n|") == 1 + 3 * 33 and EDITION_HEADERS[2023]["genai_free"] in printed


def test_mapping_report_lists_every_field(spark, lake):
    report = mapping_report(spark, open_editions(spark, lake[1].bronze)).collect()
    assert len(report) == 3 * 33
    assert {(r["survey_year"], r["field"]): r["source_header"] for r in report if r["source_header"]} == {
        (year, field): header for year, fields in EDITION_HEADERS.items() for field, header in fields.items()
    }


def test_only_mapped_columns_are_read(spark, lake, tmp_path):
    for year in EDITIONS:
        land_edition(spark, edition_path(lake[1].bronze, year), f"{tmp_path}/landed", year)
    opened = open_editions(spark, f"{tmp_path}/landed", landed=True)
    decoy = opened.catalog.filter(F.col("header").isin(*DECOY_HEADERS.values())).select("pos").distinct().collect()
    assert [r["pos"] for r in decoy] == [3]
    plan = harmonised(spark, opened)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan[plan.index("c0") :])[1].split(",")
    mapped = {r["pos"] for r in mapping(opened).filter("pos IS NOT NULL").collect()}
    assert 3 in mapped or "c3:string" not in read
    assert plan.count("FileScan parquet [c0") == 1


def test_silver_is_one_scan_without_a_shuffle_of_rows(spark, lake):
    rows = enrich(harmonised(spark, open_editions(spark, lake[1].bronze)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "SortMergeJoin" not in plan and "Python" not in plan
    # the rows are the streamed side of broadcast joins with tables of a row for each edition
    assert plan.count("BroadcastHashJoin [survey_year") >= 2


def test_rebuilding_one_edition_leaves_the_others(spark, tmp_path):
    silver = enrich(respondents(spark, SF))
    path = f"{tmp_path}/s"
    write_silver(silver, path)
    write_silver(silver.filter("survey_year = 2024").limit(3), path, editions_only=True)
    counts = {r[0]: r[1] for r in read_silver(spark, path).groupBy("survey_year").count().collect()}
    assert counts == {2023: 500, 2024: 3, 2025: 500}


def test_built_gold_equals_gold_on_respondents(spark, lake):
    root, layers = lake
    direct = gold_tables(read_silver(spark, layers.respondents))
    for name, table in direct.items():
        built = spark.read.parquet(f"{layers.gold}/{name}")
        assert built.columns == table.columns
        assert _sorted(built) == _sorted(table), name
        copy = read_gold_csv(spark, f"{root}/csv/{name}", built.schema)
        assert _sorted(copy) == _sorted(built), name


def test_gold_from_added_up_cells_equals_gold_from_units(spark):
    """Adding cells up first, in two steps, changes nothing, thresholds and null groups included."""
    silver = enrich(respondents(spark, "/root/testdata/sf0.01"))
    units = c.units(silver)
    keys = {
        "edition": (c.EDITION_KEYS, c.EDITION_MEASURES),
        "role": (c.ROLE_KEYS, c.ROLE_MEASURES),
        "place": (c.PLACE_KEYS, c.PLACE_MEASURES),
        "sector": (c.SECTOR_KEYS, c.PLACE_MEASURES),
    }
    for name, (table, source) in GOLD_TABLES.items():
        by, measures = keys[source]
        halves = c.add_up(units.withColumn("half", F.col("survey_year") % 2), [*by, "half"], measures)
        assert _sorted(table(c.add_up(halves, by, measures))) == _sorted(table(units)), name


def test_gold_filters_and_columns_reach_the_scan(spark, lake):
    silver = read_silver(spark, lake[1].respondents)
    tables = gold_tables(silver)
    market = tables["market_structure"]
    market.collect()
    plan = market._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan  # totals are made of the same groups
    assert "PushedFilters: [IsNotNull(is_employed), EqualTo(is_employed,1)]" in plan
    assert "ReadSchema: struct<job_family:string,is_employed:int>" in plan
    tech = tables["tech_adoption"]._jdf.queryExecution().executedPlan().toString()
    assert tech.count("FileScan") == 1


def test_a_question_about_one_year_reads_one_partition(spark, lake):
    tables = gold_tables(read_silver(spark, lake[1].respondents))
    for name in ("q_market_2025", "q_region", "q_genai_by_family", "q_tech_2025", "q_top_sectors"):
        plan = analyse(name, tables)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(survey_year" in plan, name


def test_a_tool_nobody_was_asked_about_keeps_its_row(spark):
    tech = gold_tables(enrich(respondents(spark, SF)))["tech_adoption"].filter("survey_year = 2023")
    rows = {r["technology"]: r for r in tech.collect()}
    assert set(rows) == set(TOOLS.values())
    assert rows["Snowflake"]["adoption_pct"] is None and rows["Snowflake"]["n"] == rows["SQL"]["n"] > 0


def test_gold_of_no_respondents(spark, tmp_path):
    empty = enrich(respondents(spark, SF)).limit(0)
    write_silver(empty, f"{tmp_path}/silver")
    assert read_silver(spark, f"{tmp_path}/silver").schema.simpleString() == empty.select(*SILVER_COLUMNS).schema.simpleString()
    tables = gold_tables(read_silver(spark, f"{tmp_path}/silver"))
    assert {name: table.count() for name, table in tables.items()} == dict.fromkeys(GOLD_TABLES, 0)


def test_the_same_analyses_as_sql(spark, lake):
    tables = {name: spark.read.parquet(f"{lake[1].gold}/{name}") for name in GOLD_TABLES}
    for year in (2024, 2025):
        for name in STATEMENTS:
            assert _sorted(ask(spark, name, tables, year)) == _sorted(analyse(name, tables, year)), name
    for name in tables:
        spark.catalog.dropTempView(name)


def test_the_jobs_from_the_command_line(spark, lake, tmp_path, monkeypatch):
    """Silver, gold and run with a real session (which outlives them here); nothing is left of the work folder."""
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    where = ["--bronze", lake[1].bronze, "--silver", f"{tmp_path}/silver", "--gold", f"{tmp_path}/gold"]
    database = "survey_jobs_test"
    try:
        jobs.main(["silver", *where])
        assert _sorted(read_silver(spark, f"{tmp_path}/silver/professionals")) == _sorted(read_silver(spark, lake[1].respondents))
        jobs.main(["gold", *where, "--database", database, "--csv", f"{tmp_path}/csv"])
        assert sorted(path.name for path in (tmp_path / "gold").iterdir()) == sorted(GOLD_TABLES)
        for name in GOLD_TABLES:
            assert _sorted(spark.table(f"{database}.{name}")) == _sorted(spark.read.parquet(f"{lake[1].gold}/{name}")), name
        jobs.main(["run", "--bronze", lake[1].bronze, "--silver", f"{tmp_path}/s", "--gold", f"{tmp_path}/g"])
        assert _sorted(spark.read.parquet(f"{tmp_path}/g/sector")) == _sorted(spark.read.parquet(f"{lake[1].gold}/sector"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_every_analysis_takes_another_year(spark, lake):
    tables = {name: spark.read.parquet(f"{lake[1].gold}/{name}") for name in GOLD_TABLES}
    for name in ANALYSES:
        rows = analyse(name, tables, 2024).collect()
        assert all(r["survey_year"] == 2024 for r in rows if "survey_year" in r and name not in _ALL_YEARS), name


_ALL_YEARS = {"q_overview", "q_market_trend", "q_gender", "q_tech_trend"}


def test_top_sectors_is_sorted_named_and_short(spark):
    tables = gold_tables(enrich(respondents(spark, "/root/testdata/sf0.01")))
    rows = analyse("q_top_sectors", tables).collect()
    assert len(rows) == 10 and all(r["sector"].strip() for r in rows)
    assert rows == sorted(rows, key=lambda r: (-r["n"], r["sector"]))


def test_measures(spark):
    rows = [("a", 1, 10.0, 1), ("a", None, 11.0, 3), ("a", 0, None, 0), ("b", None, None, 0)]
    frame = spark.createDataFrame(rows, "k string, flag int, x double, w int")
    got = {
        r["k"]: r.asDict()
        for r in frame.groupBy("k")
        .agg(
            mean("x").alias("mean"),
            flag_pct("flag").alias("flag"),
            condition_pct(F.col("flag") == 1).alias("condition"),
            weighted_mean("x", "w", 2).alias("weighted"),
            ratio("x", "w", 1).alias("ratio"),
        )
        .collect()
    }
    assert got["a"] == {"k": "a", "mean": 11.0, "flag": 50.0, "condition": 33.3, "weighted": 10.75, "ratio": 5.3}
    assert got["b"] == {"k": "b", "mean": None, "flag": None, "condition": 0.0, "weighted": None, "ratio": None}
    assert frame.agg(pick("x", "flag", 1)).first()[0] == 10.0
    shares = share_of_total(spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "y int, n int"), "n", "y").collect()
    assert sorted(map(tuple, shares)) == [(1, 1, 33.3), (1, 2, 66.7), (2, 5, 100.0)]


def test_registry_and_retention(spark, tmp_path):
    assert {tuple(r) for r in registry(spark).collect()} == set(EDITIONS.items())
    years = spark.range(12).selectExpr("id", "CAST(2020 + id AS INT) AS survey_year")
    years.write.partitionBy("survey_year").parquet(f"{tmp_path}/b")
    kept = retain_registered(spark.read.parquet(f"{tmp_path}/b"))
    assert {r["survey_year"] for r in kept.collect()} == set(EDITIONS)
    assert "PartitionFilters: [survey_year" in kept._jdf.queryExecution().executedPlan().toString()


def test_locations(monkeypatch):
    for name in ("LAKE_URI", "BRONZE_URI", "SILVER_URI", "GOLD_URI"):
        monkeypatch.delenv(name, raising=False)
    assert Locations.from_env("lake") == Locations("lake/bronze", "lake/silver", "lake/gold")
    monkeypatch.setenv("LAKE_URI", "s3a://x/lake/")
    monkeypatch.setenv("GOLD_URI", "s3a://y/gold")
    layers = Locations.from_env()
    assert (layers.respondents, layers.gold) == ("s3a://x/lake/silver/professionals", "s3a://y/gold")


def test_command_line(monkeypatch):
    calls = []
    monkeypatch.setattr(jobs, "session", lambda name: type("S", (), {"stop": lambda self: calls.append("stop")})())
    monkeypatch.setattr(jobs, "build_silver", lambda s, b, t, landed, rejects: calls.append((b, t, landed)))
    monkeypatch.setattr(jobs, "build_gold", lambda s, silver, gold, csv: calls.append((silver, gold, csv)))
    monkeypatch.setattr(jobs, "land_downloads", lambda s, d, b: calls.append((d, b)))
    monkeypatch.setattr(jobs, "register_tables", lambda s, database, gold, names: calls.append((database, gold)))
    jobs.main(["silver", "--JOB_NAME", "nightly", "--BRONZE_S3", "b", "--SILVER_S3", "s"])
    jobs.main(["gold", "--silver", "s", "--gold", "g", "--csv", "c"])
    jobs.main(["gold", "--silver", "s", "--gold", "g", "--database", "d"])
    jobs.main(["land", "--download", "2023=x", "--download", "2024=y=z", "--bronze", "b"])
    jobs.main(["run", "--bronze", "b", "--silver", "s", "--gold", "g", "--landed"])
    jobs.main(["run", "--download", "2023=x", "--bronze", "b", "--silver", "s", "--gold", "g"])
    assert calls == [
        ("b", "s/professionals", False), "stop",
        ("s/professionals", "g", "c"), "stop",
        ("s/professionals", "g", None), ("d", "g"), "stop",
        ({2023: "x", 2024: "y=z"}, "b"), "stop",
        ("b", "s/professionals", True), ("s/professionals", "g", None), "stop",
        ({2023: "x"}, "b"), ("b", "s/professionals", True), ("s/professionals", "g", None), "stop",
    ]


def test_the_session_is_stopped_when_a_job_fails(monkeypatch):
    stopped = []
    monkeypatch.setattr(jobs, "session", lambda name: type("S", (), {"stop": lambda self: stopped.append(1)})())
    monkeypatch.setattr(jobs, "build_silver", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.main(["silver"])
    assert stopped == [1]


class _Session:
    """Stands in for a session with given settings."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})()


def test_work_folders_are_fresh_folders_of_the_shared_one():
    cluster = _Session("yarn", **{"spark.checkpoint.dir": "/shared/folder/"})
    first, second = work_folder(cluster), work_folder(cluster)
    assert first != second and first.startswith("/shared/folder/surveymill-")
    assert work_folder(_Session("local[2]")).startswith("file:///tmp/checkpoints/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(_Session("yarn"))


def test_gold_folders_become_catalog_tables(spark, lake):
    database = "survey_gold_test"
    register_tables(spark, database, lake[1].gold, GOLD_TABLES)
    try:
        for name in GOLD_TABLES:
            table, files = spark.table(f"{database}.{name}"), spark.read.parquet(f"{lake[1].gold}/{name}")
            assert _sorted(table) == _sorted(files)
        assert spark.sql(f"SELECT count(*) FROM {database}.tech_adoption WHERE survey_year = 2025").first()[0] == 9
    finally:
        for name in GOLD_TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"DROP DATABASE IF EXISTS {database}")


def test_gold_kept_up_to_date_equals_a_full_build(spark, tmp_path):
    complete = enrich(respondents(spark, SF))
    path, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    write_silver(complete.filter("survey_year <> 2025").union(complete.filter("survey_year = 2023")), path)
    update_gold(spark, path, gold, [2023, 2024])
    write_silver(complete.filter("survey_year IN (2023, 2025)"), path, editions_only=True)
    tables = update_gold(spark, path, gold, [2023, 2025])
    direct = gold_tables(complete)
    for name in GOLD_TABLES:
        assert _sorted(tables[name]) == _sorted(direct[name]), name
    for cell_set in CELL_SETS:  # only the changed year is read
        plan = changed_cells(read_silver(spark, path), cell_set, [2025])._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*survey_year#\d+ = 2025", plan) or "IN (2025)" in plan, plan
    # an edition that is gone
    spark.createDataFrame([], complete.schema)
    write_silver(complete.filter("survey_year <> 2024"), path)
    tables = update_gold(spark, path, gold, [2024])
    assert {r["survey_year"] for r in tables["overview"].collect()} == {2023, 2025}


def test_contract_violations_are_counted_while_writing(spark, lake, tmp_path):
    observed = Observation("contract")
    silver = build_silver(spark, lake[1].bronze, f"{tmp_path}/silver", observed=observed)
    counts = observed.get
    assert counts["n_rows"] == silver.count() == 1500 and counts["null_years"] == counts["bad_flags"] == 0
    assert counts["unknown_bands"] == silver.filter("salary_band IS NOT NULL AND salary_midpoint IS NULL").count() > 0


def test_rejected_records_do_not_stop_the_build(spark, lake, tmp_path):
    bronze = f"{tmp_path}/bronze"
    write_bronze(spark, SF, bronze)
    file = tmp_path / "bronze" / "survey_year=2024" / "extra.csv"
    header = open_editions(spark, bronze).catalog.filter("survey_year = 2024").orderBy("pos").collect()
    with file.open("w") as out:
        csv.writer(out, lineterminator="\n").writerows([[r["header"] for r in header], ["x"] * (len(header) + 2)])
    with pytest.raises(Exception, match="cells, the header has"):
        build_silver(spark, bronze, f"{tmp_path}/s1")
    silver = build_silver(spark, bronze, f"{tmp_path}/s2", rejects=f"{tmp_path}/rejects")
    assert _sorted(silver) == _sorted(read_silver(spark, lake[1].respondents))
    (rejected,) = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert rejected["survey_year"] == 2024 and rejected["reason"] == f"a record has {len(header) + 2} cells, the header has {len(header)}"


def test_silver_in_the_catalog_has_registered_years_only(spark, tmp_path):
    rows = enrich(respondents(spark, SF)).withColumn("survey_year", F.col("survey_year") - F.col("is_employed"))
    write_silver(rows, f"{tmp_path}/s")
    database = "survey_silver_test"
    try:
        register_silver(spark, database, f"{tmp_path}/s")
        table = spark.table(f"{database}.professionals")
        assert {r[0] for r in table.select("survey_year").distinct().collect()} == set(EDITIONS)
        assert table.columns == read_silver(spark, f"{tmp_path}/s").columns or set(table.columns) == set(SILVER_COLUMNS)
        plan = table.filter("survey_year = 2024")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(survey_year" in plan
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_share_of_total_of_many_groups_is_no_window(spark):
    groups = spark.range(200_000).selectExpr("CAST(id % 2 AS INT) AS y", "id AS g", "id % 7 AS v").groupBy("y", "g").agg(F.sum("v").alias("n"))
    shared = share_of_total(groups, "n", "y", "share")
    assert "Window" not in shared._jdf.queryExecution().executedPlan().toString()
    assert shared.columns == ["y", "g", "n", "share"] and shared.count() == 200_000
    odd = spark.createDataFrame([(None, 1), (None, 3), (1, 5)], "y int, n int")
    assert sorted(map(tuple, share_of_total(odd, "n", "y").collect()), key=repr) == [(1, 5, 100.0), (None, 1, 25.0), (None, 3, 75.0)]
