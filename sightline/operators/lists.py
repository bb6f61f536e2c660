"""Per-key lists, newest first.

A list may be as long as the table, so it is kept as rows (list_key, position, value) and never
gathered into one value. Positions come from a range-partitioned sort: a hot key is spread over
many partitions, each counts its own rows, and only those counts are summed up per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline import session


def with_positions(
    rows: DataFrame, key: str, newest_first: list[Column], position: str = "position"
) -> DataFrame:
    """Add each row's 0-based position within its key.

    The sorted rows are checkpointed in the shared folder: row numbers must not change between
    counting the partitions and using the counts, also if an executor is lost in between.
    """
    session.shared_root(rows.sparkSession)
    placed = (
        rows.repartitionByRange(F.col(key), *newest_first)
        .sortWithinPartitions(F.col(key), *newest_first)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .checkpoint()
    )
    runs = placed.groupBy(key, "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select(
        key, "_part", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(offsets, [key, "_part"]).select(
        *rows.columns, (F.col("_offset") + F.col("_at") - F.col("_start")).alias(position)
    )


def pushed(rows: DataFrame, key: Column, value: Column, newest_first: list[Column]) -> DataFrame:
    """Lists after pushing every row's value to the head of its key's list, oldest first."""
    order = {f"_o{i}": c for i, c in enumerate(newest_first)}
    base = rows.select(key.alias("list_key"), value.alias("value"), *[c.alias(n) for n, c in order.items()])
    ordered = with_positions(base, "list_key", [F.col(n).desc() for n in order])
    return ordered.select("list_key", "position", "value")


def page(lists: DataFrame, first: int, last: int) -> DataFrame:
    """(list_key, values) of positions first..last; the array has at most that many values."""
    part = lists.filter(F.col("position").between(first, last))
    gathered = part.groupBy("list_key").agg(
        F.array_sort(F.collect_list(F.struct("position", "value"))).alias("_v")
    )
    return gathered.select("list_key", F.col("_v.value").alias("values"))
