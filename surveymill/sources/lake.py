"""Table sinks, scans and catalog registration for the silver and gold layers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.fixed_values import EDITIONS
from surveymill.operators.respondents import SILVER_COLUMNS, SILVER_SCHEMA
from surveymill.sources.editions import RESPONDENTS

# A cell is written exactly as it is: no trimming, quotes doubled.
_CSV = {"header": True, "escape": '"', "multiLine": True}
_CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


#: Rows of a table of editions or headers up to which it may be broadcast (a few hundred bytes each).
SMALL_ROWS = 100_000


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the one ``spark.checkpoint.dir`` names; a local session may name none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = "file:///tmp/checkpoints"
    return f"{shared.rstrip('/')}/surveymill-{uuid.uuid4().hex}"


def is_small(frame: DataFrame) -> bool:
    return frame.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def small(frame: DataFrame) -> DataFrame:
    """The table marked for a broadcast join if it has few rows; else Spark joins it as it sees fit."""
    return F.broadcast(frame) if is_small(frame) else frame


def stage(frame: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result once and go on from the written table."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_silver(silver: DataFrame, path: str, editions_only: bool = False) -> None:
    """Parquet, one partition per survey year; ``editions_only`` replaces just the years written."""
    mode = "dynamic" if editions_only else "static"
    (
        silver.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("survey_year")
        .parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The respondent table in its canonical column order (the partition column is read last)."""
    return spark.read.schema(SILVER_SCHEMA).parquet(path).select(*SILVER_COLUMNS)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_gold(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").parquet(path)


def read_gold(spark: SparkSession, gold: str, names) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{gold.rstrip('/')}/{name}") for name in names}


def write_gold_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").options(**_CSV_WRITE).csv(path)


def read_gold_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.options(**_CSV).schema(schema).csv(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the gold tables available to ``spark.sql`` under their names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def register_tables(spark: SparkSession, database: str, gold: str, names) -> None:
    """Register gold folders as external tables of a catalog database."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"{database}.{name}", path=f"{gold.rstrip('/')}/{name}", source="parquet")


def register_silver(spark: SparkSession, database: str, path: str, editions: Mapping[int, str] = EDITIONS, name: str = RESPONDENTS) -> None:
    """Register the respondent table, partitioned by year, with the partitions of registered editions.

    Partitions are found in the folder; those of years that are not registered are dropped from the catalog (their files stay).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in SILVER_SCHEMA)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE `{database}`.`{name}` ({columns}) USING parquet PARTITIONED BY (survey_year) LOCATION '{location}'")
    spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
    years = {int(row[0].partition("=")[2]) for row in spark.sql(f"SHOW PARTITIONS `{database}`.`{name}`").collect()}  # a row for each year
    for year in sorted(years - set(editions)):
        spark.sql(f"ALTER TABLE `{database}`.`{name}` DROP PARTITION (survey_year = {year})")
