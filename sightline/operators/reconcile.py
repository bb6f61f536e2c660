"""Reconciliation of two ingests of the same feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(primary: DataFrame, shadow: DataFrame, key: str) -> DataFrame:
    """(key, n_primary, n_shadow) over all keys of both ingests.

    Both sides are counted in one aggregation that combines before the shuffle; an anti join in
    each direction would shuffle every copy of a repeated key twice.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = primary.select(key, one.alias("p"), none.alias("s")).unionByName(
        shadow.select(key, none.alias("p"), one.alias("s"))
    )
    return both.groupBy(key).agg(F.sum("p").alias("n_primary"), F.sum("s").alias("n_shadow"))


def missing(primary: DataFrame, shadow: DataFrame, key: str) -> DataFrame:
    """The keys that one of the ingests lacks."""
    return presence(primary, shadow, key).filter((F.col("n_primary") == 0) | (F.col("n_shadow") == 0))


def lost_rows(primary: DataFrame, shadow: DataFrame, key: str) -> DataFrame:
    """The whole rows of ``primary`` that ``shadow`` lacks."""
    return primary.join(shadow.select(key), key, "left_anti")
