"""Counts and groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **flags: Column) -> tuple[DataFrame, Observation]:
    """Count all rows, and those of each flag, while an action on the result runs anyway."""
    metrics = Observation(name)
    counts = [F.count_if(flag).alias(label) for label, flag in flags.items()]
    return df.observe(metrics, F.count(F.lit(1)).alias("n_rows"), *counts), metrics


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def distinct_per_day(df: DataFrame, day: str, entity: str, approximate: bool = False) -> DataFrame:
    """Distinct entities per day.

    Exact: (day, entity) is reduced first, spread over both, so a hot day is no hot task. The
    approximate form needs no second shuffle and keeps one sketch per day.
    """
    if approximate:
        return df.groupBy(day).agg(F.approx_count_distinct(entity).alias("n_entities"))
    pairs = df.groupBy(day, entity).agg(F.lit(1).alias("_one"))
    return pairs.groupBy(day).agg(F.count(entity).alias("n_entities"))


def per_group(df: DataFrame, group: str, seconds: str, entity: str) -> DataFrame:
    """Rows, first and last time, and distinct entities of each group."""
    partial = df.groupBy(group, entity).agg(
        F.count("*").alias("_n"), F.min(seconds).alias("_first"), F.max(seconds).alias("_last")
    )
    return partial.groupBy(group).agg(
        F.sum("_n").alias("n_rows"), F.min("_first").alias("first_time"),
        F.max("_last").alias("last_time"), F.count(entity).alias("n_entities"),
    )
