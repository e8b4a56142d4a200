"""Line deduplication by site-relative frequency.

A line is boilerplate of its host if the share of the host's pages that contain it exceeds a ratio, with certainty: the share
counts by the lower end of its score interval, which comes near the share itself as pages grow in number and says
little for a line of a single page. Line counts are pre-aggregated by (host, line hash); a line is known by the
64-bit hash of its text within its host, and dropped by it. The lines that exceed the ratio are few for any host: with r lines a
page on average there are r / ratio of them at most. They go back to the pages as one array for each host; what a page
has of them is their intersection, by hashing, and few, and the page drops these in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveymill.llm.common import stage

RATIO = 0.1
DEVIATIONS = 3.0  # half width of the score interval in standard deviations


def lower_share(n: Column, pages: Column, deviations: float = DEVIATIONS) -> Column:
    """The lower end of the score interval of n / pages."""
    square = F.lit(deviations * deviations)
    return (n + square / 2 - F.lit(deviations) * F.sqrt(n * (pages - n) / pages + square / 4)) / (pages + square)


def boilerplate_lines(
    pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, deviations: float = DEVIATIONS
) -> DataFrame:
    """``(host, lines)``: the hashes of each host's boilerplate lines, in order; hosts without any are left out."""
    rows = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).filter("host IS NOT NULL")
    # staged, so that its size is known, and that a host with many lines can be split in the join below
    totals = stage(rows.groupBy("host").agg(F.count("*").alias("pages")), "boilerplate-hosts")
    line = F.explode(F.array_distinct(F.split("text", "\n")))
    lines = rows.select("host", line.alias("line")).filter("trim(line) <> ''")
    counts = lines.select("host", F.xxhash64("line").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    common = counts.join(totals, "host").filter(lower_share(F.col("n"), F.col("pages"), deviations) > F.lit(ratio))
    return common.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("lines"))


def drop_boilerplate(
    pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, deviations: float = DEVIATIONS
) -> DataFrame:
    """All rows and columns of ``pages``, with boilerplate lines taken out of the text.

    A line counts once for a row however often it occurs there, and every occurrence is dropped. Defined
    cases: blank lines are neither counted nor dropped; a null text stays null; a text of boilerplate only
    becomes empty; rows without host are left alone (they have no site); repeated rows are pages of their
    own; an empty table stays empty; columns of any other name are carried along. The text goes through one
    join, on the host, that Spark makes a broadcast if the table of lines is small and otherwise splits where
    a host is large (the table is staged, so its size is known).
    """
    names = pages.columns
    numbered = pages.toDF(*[f"c{i}" for i in range(len(names))])
    host, text = (f"c{names.index(name)}" for name in (host_col, text_col))
    known = stage(boilerplate_lines(numbered, host, text, ratio, deviations), "boilerplate")
    known = known.withColumnRenamed("host", "known_host")
    joined = numbered.join(known, F.col(host) == F.col("known_host"), "left")
    # the host's lines that are on the page, by a hash set, however many the host has; most pages have few or none
    own = f"array_intersect(transform(split({text}, '\n'), l -> xxhash64(l)), lines)"
    kept = f"array_join(filter(split({text}, '\n'), l -> trim(l) = '' OR NOT array_contains(own, xxhash64(l))), '\n')"
    joined = joined.withColumn("own", F.expr(f"IF(lines IS NULL OR {text} IS NULL, NULL, {own})"))
    cleaned = F.when(F.coalesce(F.size("own"), F.lit(0)) <= 0, F.col(text)).otherwise(F.expr(kept))
    return joined.select(*[(cleaned if f"c{i}" == text else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)])
