"""Entity timelines at one row per entity and second.

Last-seen and neighbour questions depend on *when* an entity was seen, not on how many rows say
so. Rows are therefore reduced to distinct seconds before anything is ordered per entity. The
reduction is shuffled by (entity, second), so a hot entity is spread over all tasks; afterwards
an entity has at most 86,400 rows per day, however many events it had. Results go back to the
events by a join on (entity, second), whose hot seconds adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_seconds(rows: DataFrame, entity: str, seconds: str, row_id: str) -> DataFrame:
    """(entity, sec, first_id, repeated): ``repeated`` if more than one event has that second.

    Copies of one event (same id) count once, so a replayed event changes nothing.
    """
    return (
        rows.filter(F.col(entity).isNotNull() & F.col(seconds).isNotNull())
        .groupBy(F.col(entity).alias("entity"), F.col(seconds).alias("sec"))
        .agg(F.min(row_id).alias("first_id"), F.max(row_id).alias("_last_id"))
        .select("entity", "sec", "first_id", (F.col("first_id") < F.col("_last_id")).alias("repeated"))
    )


def attach(rows: DataFrame, per_second: DataFrame, entity: Column, seconds: str) -> DataFrame:
    """Left join of per-second results to the events; ``entity`` may be NULL to match nothing."""
    keyed = rows.withColumns({"_entity": entity, "_sec": F.col(seconds)})
    side = per_second.withColumnsRenamed({"entity": "_entity", "sec": "_sec"})
    return keyed.join(side, ["_entity", "_sec"], "left").drop("_entity", "_sec")
