"""Command line of the pipeline, for spark-submit.

    python -m surveymill.jobs land    --download 2023=PATH --download 2024=PATH ... [--bronze URI]
    python -m surveymill.jobs mapping [--bronze URI] [--landed]
    python -m surveymill.jobs silver  [--bronze URI] [--silver URI] [--landed] [--rejects URI]
    python -m surveymill.jobs gold    [--silver URI] [--gold URI] [--csv URI] [--database NAME] [--changed YEAR ...]
    python -m surveymill.jobs run     [all of these]

``mapping`` prints which source column each field takes. ``run`` lands the downloads, if any, and
builds silver and gold. With ``--database`` the respondent table (with the partitions of registered years only) and
the gold tables are registered in the catalog, so that SQL users find them. Layer locations default to BRONZE_URI, SILVER_URI and GOLD_URI, and these
to folders of LAKE_URI. The names --BRONZE_S3, --SILVER_S3 and --GOLD_S3 are accepted as well, and
--JOB_NAME names the job.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from surveymill.plans.gold import build_gold, update_gold
from surveymill.plans.silver import build_silver, mapping_report, open_editions
from surveymill.session import session
from surveymill.sources.editions import Locations
from surveymill.sources.lake import register_silver, register_tables
from surveymill.sources.landing import land_downloads


def run(
    spark: SparkSession,
    layers: Locations,
    downloads: Mapping[int, str] | None = None,
    landed: bool = False,
    csv: str | None = None,
    database: str | None = None,
    rejects: str | None = None,
) -> dict[str, DataFrame]:
    """Landing (when there are downloads), silver and gold. The caller owns the session."""
    if downloads:
        land_downloads(spark, downloads, layers.bronze)
    build_silver(spark, layers.bronze, layers.respondents, landed=landed or bool(downloads), rejects=rejects)
    if database is not None:
        register_silver(spark, database, layers.respondents)
    return gold_job(spark, layers, csv, database)


def gold_job(
    spark: SparkSession, layers: Locations, csv: str | None = None, database: str | None = None, changed: Sequence[int] = ()
) -> dict[str, DataFrame]:
    """The gold tables, registered in a catalog database if one is named. With ``changed`` years only these are read
    anew, the others come from the cell store."""
    if changed:
        tables = update_gold(spark, layers.respondents, layers.gold, changed, csv)
    else:
        tables = build_gold(spark, layers.respondents, layers.gold, csv)
    if database is not None:
        register_tables(spark, database, layers.gold, tables)
    return tables


def print_mapping(spark: SparkSession, bronze: str, landed: bool = False) -> None:
    report = mapping_report(spark, open_editions(spark, bronze, landed=landed)).orderBy("survey_year", "field")
    lines = report.collect()  # a line for each edition and field
    spark.createDataFrame(lines, report.schema).show(len(lines), truncate=False)


def _download(text: str) -> tuple[int, str]:
    year, _, path = text.partition("=")
    return int(year), path


def _arguments(argv=None) -> argparse.Namespace:
    layers = Locations.from_env()
    parser = argparse.ArgumentParser(prog="surveymill", allow_abbrev=False)
    parser.add_argument("job", choices=["land", "mapping", "silver", "gold", "run"])
    for layer in ("bronze", "silver", "gold"):
        parser.add_argument(f"--{layer}", f"--{layer.upper()}_S3", dest=layer, default=getattr(layers, layer))
    parser.add_argument("--JOB_NAME", dest="name")
    parser.add_argument("--download", type=_download, action="append", default=[], metavar="YEAR=FOLDER")
    parser.add_argument("--landed", action="store_true", help="the bronze layer holds landed Parquet copies")
    parser.add_argument("--rejects", help="write CSV records with more cells than their header here, instead of stopping at one")
    parser.add_argument("--csv", help="also write the gold tables as CSV below this location")
    parser.add_argument("--database", help="catalog database to register the respondent and gold tables in")
    parser.add_argument("--changed", type=int, action="append", default=[], metavar="YEAR", help="gold: read only these years anew")
    return parser.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> None:
    """One job by its arguments. A session that is handed in stays with its owner; else the job has one of its own."""
    args = _arguments(argv)
    if spark is not None:
        _run(spark, args)
        return
    own = session(args.name or f"surveymill-{args.job}")
    try:
        _run(own, args)
    finally:
        own.stop()


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    layers = Locations(args.bronze, args.silver, args.gold)
    if args.job == "land":
        land_downloads(spark, dict(args.download), layers.bronze)
    elif args.job == "mapping":
        print_mapping(spark, layers.bronze, args.landed)
    elif args.job == "silver":
        build_silver(spark, layers.bronze, layers.respondents, landed=args.landed, rejects=args.rejects)
        if args.database:
            register_silver(spark, args.database, layers.respondents)
    elif args.job == "gold":
        gold_job(spark, layers, args.csv, args.database, args.changed)
    else:
        run(spark, layers, dict(args.download), args.landed, args.csv, args.database, args.rejects)


if __name__ == "__main__":
    main()
