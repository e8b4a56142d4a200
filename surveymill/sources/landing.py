"""Landing: downloaded editions become Parquet copies in the bronze layer.

A copy keeps every cell as raw text, in splittable files of a bounded number of records, in its ``survey_year=`` partition.
What was landed is recorded in a manifest beside the copies: the source file, its length and time, and the
header. A later run lands only editions whose source has changed since, and replaces only their partitions.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from surveymill.sources.editions import edition_path
from surveymill.sources.survey_csv import Edition, Editions, csv_files, scan_editions

MAX_RECORDS = 1_000_000  # records of a landed file
_SOURCE = ("survey_year", "file", "length", "modified")
MANIFEST = "file string, length long, modified timestamp, header array<string>, survey_year int"


def manifest_path(bronze: str) -> str:
    return f"{bronze.rstrip('/')}/_landed"


def read_manifest(spark: SparkSession, bronze: str) -> DataFrame:
    """``(file, length, modified, header, survey_year)``, a row for each source file; empty before the first landing."""
    try:
        return spark.read.schema(MANIFEST).parquet(manifest_path(bronze))
    except AnalysisException:  # no such path
        return spark.createDataFrame([], MANIFEST)


def pick_largest(spark: SparkSession, folder: str) -> str:
    """Path of the largest CSV file below a folder; equal sizes go by path."""
    return _largest(spark, folder)["path"]


def _largest(spark: SparkSession, folder: str):
    largest = csv_files(spark, folder).orderBy(F.desc("length"), "path").first()
    if largest is None:
        raise FileNotFoundError(f"no CSV file below {folder}")
    return largest


def changed_sources(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """All sources ``(survey_year, file, length, modified)`` of the editions that were not landed from just these files."""
    new = sources.join(manifest, list(_SOURCE), "left_anti").select("survey_year")
    gone = manifest.join(sources, list(_SOURCE), "left_anti").select("survey_year")
    return sources.join(new.unionAll(gone).distinct(), "survey_year", "left_semi").select(*_SOURCE)


def land(spark: SparkSession, sources: DataFrame, bronze: str, max_records: int = MAX_RECORDS) -> list[int]:
    """Land the editions whose sources have changed, in one write; the years that were. Others are not touched."""
    found = changed_sources(sources, read_manifest(spark, bronze)).collect()  # a row for each source file of these editions
    if not found:
        return []
    files = spark.createDataFrame(found, sources.select(*_SOURCE).schema)
    years = sorted({row["survey_year"] for row in found})
    where = {row["file"]: unquote(row["file"]) for row in found}
    editions = scan_editions(spark, where, files.select("file", "survey_year"), years=len(years))
    # the source comes before the copy: a landing that fails between the two is repeated
    out = editions.rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records)
    out.partitionBy("survey_year").parquet(bronze)
    headers = editions.catalog.groupBy("survey_year").agg(F.array_sort(F.collect_list(F.struct("pos", "header"))).alias("header"))
    headers = headers.select("survey_year", F.col("header.header").alias("header"))
    landed = files.join(headers, "survey_year").select("file", "length", "modified", "header", "survey_year")
    landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("survey_year").parquet(manifest_path(bronze))
    return years


def land_edition(spark: SparkSession, source: str, bronze: str, survey_year: int) -> str:
    """Copy all CSV files below a path into a ``survey_year=`` partition of the bronze layer, unless they are there already."""
    sources = csv_files(spark, source).withColumn("survey_year", F.lit(survey_year))
    land(spark, sources.select(*_SOURCE), bronze)
    return edition_path(bronze, survey_year)


def land_downloads(spark: SparkSession, downloads: Mapping[int, str], bronze: str) -> dict[int, str]:
    """Land the largest CSV of every edition's download folder, where it has changed."""
    picked = [{"survey_year": year, **_largest(spark, folder).asDict()} for year, folder in downloads.items()]
    sources = spark.createDataFrame(
        [tuple(row[name] for name in _SOURCE) for row in picked], "survey_year int, file string, length long, modified timestamp"
    )
    land(spark, sources, bronze)
    return {year: edition_path(bronze, year) for year in downloads}


def read_landed_editions(spark: SparkSession, bronze: str, years) -> Editions:
    """The landed copies of some years, in one plan; their headers come from the manifest."""
    manifest = read_manifest(spark, bronze).filter(F.col("survey_year").isin(*years))
    headers = manifest.groupBy("survey_year").agg(F.first("header").alias("header"))
    missing = set(years) - {row["survey_year"] for row in headers.select("survey_year").collect()}
    if missing:
        raise FileNotFoundError(f"editions that were not landed: {sorted(missing)}")
    catalog = headers.select("survey_year", F.posexplode("header").alias("pos", "header"))
    width = headers.agg(F.max(F.size("header"))).first()[0]
    schema = ", ".join([*(f"c{pos} string" for pos in range(width)), "survey_year int"])
    rows = spark.read.schema(schema).parquet(bronze).filter(F.col("survey_year").isin(*years))
    return Editions(catalog, rows)


def read_landed(spark: SparkSession, path: str) -> Edition:
    """One landed edition by the path of its partition."""
    bronze, _, year = path.rstrip("/").rpartition("/survey_year=")
    editions = read_landed_editions(spark, bronze, [int(year)])
    names = [row["header"] for row in editions.catalog.orderBy("pos").collect()]
    return Edition(names, editions.rows.select(*[f"c{pos}" for pos in range(len(names))]))
