"""Neighbouring sightings and lateness by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline import schemas
from sightline.operators import ordered
from sightline.operators.filters import valid_entity


def next_sighting(
    late: DataFrame,
    seen: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    within: int | None = None,
) -> DataFrame:
    """Add (next_id, next_time): the same entity's first sighting after each row of ``late``.

    Both are NULL when there is none, or none within ``within`` seconds.
    """
    points = seen.select(
        F.col(entity).alias("entity"), F.col(seconds).cast("bigint").alias("sec"), F.col(row_id).alias("id"),
        F.lit(True).alias("seen"),
    )
    whole = F.struct(*late.columns)
    asked = late.select(
        F.col(entity).alias("entity"), F.col(seconds).cast("bigint").alias("sec"),
        F.lit(None).cast(seen.schema[row_id].dataType).alias("id"), F.lit(False).alias("seen"), whole.alias("row"),
    )
    both = asked.unionByName(points.withColumn("row", F.lit(None).cast(asked.schema["row"].dataType)))
    found = ordered.neighbours(both, forward=True)
    hit = F.lit(True) if within is None else F.col("near_sec") - F.col(seconds) <= within
    return found.select(
        *late.columns, F.when(hit, F.col("near_id")).alias("next_id"), F.when(hit, F.col("near_sec")).alias("next_time")
    )


def late_neighbours(
    rows: DataFrame,
    seen: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    delta: str = "last_captured",
    limit: int = schemas.LATE_SEARCH_SECONDS,
) -> DataFrame:
    """The late branch: rows late by less than ``limit`` get their next sighting.

    Rows of untracked entities, and those that are later still, get the delta -1; only rows with
    a negative delta above that are looked up.
    """
    searched = valid_entity(F.col(entity)) & (F.col(delta) > -limit)
    asked = rows.withColumns({
        "_asked": F.when(searched & (F.col(delta) < 0), F.col(entity)),
        delta: F.when(searched, F.col(delta)).otherwise(-1).cast("bigint"),
    })
    named = seen.withColumn("_asked", F.col(entity))
    return next_sighting(asked, named, "_asked", seconds, row_id).drop("_asked")


def running_max(
    rows: DataFrame, key: str, arrival: str, value: str, result: str, chunk: int = 1 << 16
) -> DataFrame:
    """Add the greatest ``value`` of the key's rows that arrived before this one.

    ``arrival`` is a unique sequence number. Rows are ordered within chunks of ``chunk``
    numbers; between chunks only their maxima are carried over.
    """
    keyed = rows.withColumn("_chunk", F.floor(F.col(arrival) / chunk))
    inside = W.partitionBy(key, "_chunk").orderBy(arrival).rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        keyed.groupBy(key, "_chunk").agg(F.max(value).alias("_top"))
        .select(key, "_chunk", F.max("_top").over(across).alias("_carried"))
    )
    return (
        keyed.withColumn("_inside", F.max(value).over(inside))
        .join(carried, [key, "_chunk"])
        .select(*rows.columns, F.greatest("_inside", "_carried").alias(result))
    )


def arrival_delta(rows: DataFrame, key: str, arrival: str, seconds: str, result: str = "delta") -> DataFrame:
    """Add the row's time minus the latest time seen before it; NULL for a first sighting."""
    seen = running_max(rows, key, arrival, seconds, "_seen")
    return seen.withColumn(result, F.col(seconds) - F.col("_seen")).drop("_seen")


def late_class(delta: Column, search_limit: int = schemas.LATE_SEARCH_SECONDS) -> Column:
    """``first``, ``on_time``, ``late`` (searched for a neighbour) or ``history`` (too late)."""
    return (
        F.when(delta.isNull(), "first")
        .when(delta >= 0, "on_time")
        .when(delta > -search_limit, "late")
        .otherwise("history")
    )
