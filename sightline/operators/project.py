"""Event rows to warehouse rows, coded documents and defaulted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import schemas
from sightline.functions import keys, timecodes


def warehouse_row(
    events: DataFrame, buckets: int | None = None, convert_create_time: bool = True
) -> DataFrame:
    """Format 1 events to the warehouse row; ``dateid`` is last, as the partition column.

    With ``buckets`` the brand's bucket comes just before it. The shadow ingest keeps the
    creation time in digits; that is ``convert_create_time=False``.
    """
    converted = ("capturetime", "createtime") if convert_create_time else ("capturetime",)

    def column(name: str, field: str | None) -> Column:
        if field is None:
            return F.lit(schemas.UNKNOWN_CODE).alias(name)
        if name in converted:
            return timecodes.epoch_seconds(F.col(field)).alias(name)
        return F.col(field).alias(name)

    row = [column(name, field) for name, field in schemas.WAREHOUSE_FIELDS.items()]
    if buckets:
        row.append(keys.bucket(F.col("brandId"), buckets).alias("brandpartition"))
    row.append(timecodes.day_id(F.col("captureTime")).alias("dateid"))
    return events.select(*row)


def first_warehouse_row(events: DataFrame) -> DataFrame:
    """Format 1 events to the first generation of the row, with a TIMESTAMP and a text direction."""
    return events.select(
        F.col("id").alias("solrid"), F.col("plateNumber").alias("platenumber"),
        timecodes.parse_time(F.col("captureTime")).alias("capturetime"),
        F.col("directionId").alias("directionid"), F.col("colorId").alias("colorid"),
        F.col("modelId").alias("modelid"), F.col("brandId").alias("brandid"),
        F.col("levelId").alias("levelid"), F.col("yearId").alias("yearid"),
        F.col("feature").alias("recfeature"), timecodes.day_id(F.col("captureTime")).alias("dateid"),
        F.col("locationuuid").alias("locationid"),
    )


def index_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.INDEX_COLUMNS)


def coded(events: DataFrame, mapping: dict[str, str | None]) -> DataFrame:
    """Rename event fields to their document codes; a code without a field is empty text."""
    return events.select(
        *[(F.lit("") if src is None else F.col(src)).alias(code) for code, src in mapping.items()]
    )


def default_nulls(
    events: DataFrame, region: int = schemas.UNKNOWN_REGION_V2, now: Column | None = None
) -> DataFrame:
    """Replace every NULL by its sink default: codes, text, region, and times by ``now``."""
    clock = F.unix_timestamp(F.current_timestamp() if now is None else now)
    filled = events.fillna(schemas.sink_defaults(events.schema, region))
    times = {
        name: F.coalesce(F.col(name), clock)
        for name in ("captureTime", "sendTime")
        if name in events.columns
    }
    return filled.withColumns(times) if times else filled
