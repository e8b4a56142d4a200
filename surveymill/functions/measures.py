"""Aggregate expressions shared by the gold tables and the analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(value: Column | str, digits: int = 0) -> Column:
    """Rounded mean of the non-null values."""
    return F.round(F.avg(value), digits)


def flag_pct(flag: Column | str, digits: int = 1) -> Column:
    """Share of ones among the answered (non-null) flags, in percent."""
    return F.round(F.avg(flag) * 100, digits)


def condition_pct(condition: Column, digits: int = 1) -> Column:
    """Share of all rows that meet a condition, in percent; an unknown condition is not met."""
    return F.round(F.avg(F.when(condition, 1).otherwise(0)) * 100, digits)


def ratio(total: Column | str, weight: Column | str, digits: int, scale: int = 1) -> Column:
    """sum(total) / sum(weight), rounded; null where the weights add up to nothing."""
    return F.round(F.try_divide(F.sum(total), F.sum(weight)) * scale, digits)


def weighted_mean(value: Column | str, weight: Column | str, digits: int) -> Column:
    """Mean of already aggregated values, each weighted with its group size."""
    value, weight = (F.col(c) if isinstance(c, str) else c for c in (value, weight))
    return F.round(F.try_divide(F.sum(value * weight), F.sum(weight)), digits)


def pick(value: Column | str, key: Column | str, wanted) -> Column:
    """The value of the row whose key is ``wanted`` (a pivot cell)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.max(F.when(key == wanted, F.col(value) if isinstance(value, str) else value))


def share_of_total(grouped: DataFrame, value: str, within: str, name: str = "share_pct") -> DataFrame:
    """Percentage of each group in the total of its ``within`` key; groups without a key are together.

    ``grouped`` is an aggregate: one row per group. Totals are added up a second time from it and joined back, so that no task
    holds all groups of a key: partial sums come from every task, and where a key has many groups Spark splits them.
    """
    totals = grouped.groupBy(F.col(within).alias("_within")).agg(F.sum(value).alias("_total"))
    joined = grouped.join(totals, F.col(within).eqNullSafe(F.col("_within")))
    return joined.withColumn(name, F.round(F.col(value) / F.col("_total") * 100, 1)).drop("_within", "_total")
