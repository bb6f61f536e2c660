"""Versioned cells: one row per (rowkey, qualifier, version) with a text value.

The latest version of a cell is its value; older ones stay readable. Versions are computed from
the row itself, so writing a batch twice yields the same cells, and readers that reduce to one
value per version do not see the difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import schemas
from sightline.functions import keys, timecodes, vectors


def to_cells(rows: DataFrame, rowkey: str, version: str, columns: list[str]) -> DataFrame:
    """Wide rows to cells; a NULL column writes no cell."""
    text = rows.select(
        F.col(rowkey).cast("string").alias("rowkey"),
        F.col(version).cast("bigint").alias("version"),
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    return (
        text.unpivot(["rowkey", "version"], columns, "qualifier", "value")
        .filter(F.col("value").isNotNull())
        .select("rowkey", "qualifier", "version", "value")
    )


def latest(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """The newest value per qualifier, one wide row per rowkey, in one aggregation.

    It combines on the map side, so a rowkey with many versions shuffles one row per task.
    """
    newest = [
        F.max(F.when(F.col("qualifier") == q, F.struct("version", "value"))).alias(q) for q in qualifiers
    ]
    wide = cells.filter(F.col("qualifier").isin(qualifiers)).groupBy("rowkey").agg(*newest)
    return wide.select("rowkey", *[F.col(f"{q}.value").alias(q) for q in qualifiers])


def all_versions(cells: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Every version of the rows whose key is in ``wanted``; keys are reversed in the table."""
    rowkeys = wanted.select(keys.reverse_key(F.col(key)).alias("rowkey"))
    return cells.join(rowkeys, "rowkey", "left_semi")


def location_time_index(rows: DataFrame, clock: Column | None = None) -> DataFrame:
    """Warehouse rows to index cells under ``location_time``; qualifier ``pass``.

    The version is time(10) + year(4) + tie-break(3); ``clock`` replaces the event time in it.
    """
    seconds = F.col("capturetime") if clock is None else clock
    return rows.select(
        keys.packed(F.col("locationid"), F.col("capturetime")).alias("rowkey"),
        F.lit("pass").alias("qualifier"),
        keys.version_of(
            seconds, keys.zero_pad(F.col("yearid"), 4), keys.zero_pad(keys.tiebreak(F.col("solrid")), 3)
        ).alias("version"),
        keys.packed(*[F.col(c) for c in schemas.PACKED_PASS_FIELDS]).alias("value"),
    )


def category_hour_index(rows: DataFrame) -> DataFrame:
    """Warehouse rows that have a feature to cells under the UUID of ``year_hour``.

    The version is time(10) + tie-break(3) + feature checksum(3); the value packs feature,
    entity, id and time.
    """
    present = rows.filter(F.col("recfeature").isNotNull() & (F.col("recfeature") != ""))
    hour = keys.packed(F.col("yearid"), timecodes.hour_tag(F.col("capturetime")))
    return present.select(
        keys.name_uuid(hour).alias("rowkey"),
        F.lit("yearids").alias("qualifier"),
        keys.version_of(
            F.col("capturetime"),
            keys.zero_pad(keys.tiebreak(F.col("solrid")), 3),
            keys.zero_pad(vectors.byte_checksum(F.col("recfeature")), 3),
        ).alias("version"),
        keys.packed(
            F.col("recfeature"), F.col("platenumber"), F.col("solrid"), F.col("capturetime")
        ).alias("value"),
    )
