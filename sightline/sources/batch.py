"""Batch scans."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet folders as one scan; ``merge_schema`` when days differ in their columns."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def day(table: DataFrame, day_id: int, column: str = "dateid") -> DataFrame:
    """One day of a day-partitioned table; only that partition is listed and read."""
    return table.filter(F.col(column) == day_id)


def days_between(table: DataFrame, first: int, last: int, column: str = "dateid") -> DataFrame:
    """Consecutive days as one pruned scan, instead of a union that grows with the days."""
    return table.filter(F.col(column).between(first, last))


def union_days(tables: Iterable[DataFrame]) -> DataFrame:
    """Tables of separate days as one; columns that a day lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def jdbc_dimension(
    spark: SparkSession,
    url: str,
    table: str,
    columns: list[str],
    properties: dict[str, str] | None = None,
    split_on: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A dimension of an external database, projected there.

    ``split_on`` is (column, lower, upper, partitions) for tables worth reading in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if split_on:
        column, lower, upper, partitions = split_on
        reader = (
            reader.option("partitionColumn", column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load().select(*columns)


def dimension(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A dimension kept as Parquet: target name -> source column."""
    return spark.read.parquet(path).select(*[F.col(src).alias(dst) for dst, src in columns.items()])
