"""Lookups against dimension tables.

No broadcast is forced. Spark broadcasts a dimension by itself when its size, estimated or
measured at run time, is below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined
by a shuffle in which adaptive execution splits hot fact keys. The dimension is reduced to one
row per key first, so a lookup can neither add nor lose fact rows; that step leaves it
partitioned by the key, as the shuffled join needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(dim: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """One row per key: the greatest value row, so the choice does not depend on the order."""
    if len(values) == 1:
        return dim.groupBy(*on).agg(F.max(values[0]).alias(values[0]))
    picked = dim.groupBy(*on).agg(F.max(F.struct(*values)).alias("_v"))
    return picked.select(*on, *[F.col(f"_v.{v}").alias(v) for v in values])


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    defaults: dict[str, object],
    unique: bool = False,
) -> DataFrame:
    """Left lookup of the columns in ``defaults``; a miss or a NULL gets the default.

    ``unique`` says that the dimension is known to hold one row per key.
    """
    values = list(defaults)
    side = dim.select(*on, *values)
    if not unique:
        side = one_per_key(side, on, values)
    joined = facts.join(side, on, "left")
    filled = {name: F.coalesce(F.col(name), F.lit(default)) for name, default in defaults.items()}
    order = facts.columns + values
    return joined.withColumns(filled).select(*order)


def lookup_by_part(
    facts: DataFrame,
    dims: dict[int, DataFrame],
    part: str,
    on: list[str],
    defaults: dict[str, object],
) -> DataFrame:
    """Look up in the dimension that belongs to the row's part type; others get the default.

    The dimensions are stacked under their part type, so one join serves all of them.
    """
    stacked = None
    for kind, dim in dims.items():
        tagged = dim.select(F.lit(kind).alias(part), *on, *defaults)
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return lookup(facts, stacked, [part, *on], defaults)


def masked_key(key: Column, unknown: object = 0) -> Column:
    """NULL for the code that stands for an unknown key, so it cannot match anything."""
    return F.when(key != unknown, key)
