"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The respondent projection has 43 columns. Generated as one method it passes the size up to which
# the JVM compiles methods (8000 bytes) and runs interpreted, about four times slower. With this
# limit such a stage is generated as many small methods instead; smaller stages stay fused.
# Rows of a few years are written to a file each without a sort by year before; beyond that number they are sorted.
_RUNTIME = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.maxConcurrentOutputFileWriters": "4"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; cluster settings stay the caller's."""
    for name, value in _RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def session(app_name: str) -> SparkSession:
    """Session of a submitted job: master, memory and shuffle settings come from spark-submit."""
    return tune(SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false").getOrCreate())
