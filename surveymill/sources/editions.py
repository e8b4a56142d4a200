"""Edition registry, edition retention and where the layers live."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.fixed_values import EDITIONS

RESPONDENTS = "professionals"


def registry(spark: SparkSession, editions: Mapping[int, str] = EDITIONS) -> DataFrame:
    """The registered editions as a dimension table ``(survey_year, edition)``."""
    return spark.createDataFrame(list(editions.items()), "survey_year int, edition string")


def retain_registered(bronze: DataFrame, editions: Mapping[int, str] = EDITIONS) -> DataFrame:
    """Rows of registered editions. On a table partitioned by year the others are never opened."""
    return bronze.filter(F.col("survey_year").isin(*editions))


def edition_path(bronze: str, survey_year: int) -> str:
    return f"{bronze.rstrip('/')}/survey_year={survey_year}"


@dataclass(frozen=True)
class Locations:
    """Layer locations: any path or URI Spark can open."""

    bronze: str
    silver: str
    gold: str

    @classmethod
    def from_env(cls, default_lake: str = "data/lake") -> "Locations":
        lake = os.environ.get("LAKE_URI", default_lake).rstrip("/")
        layers = ("bronze", "silver", "gold")
        return cls(*(os.environ.get(f"{layer.upper()}_URI", f"{lake}/{layer}") for layer in layers))

    @property
    def respondents(self) -> str:
        return f"{self.silver.rstrip('/')}/{RESPONDENTS}"
