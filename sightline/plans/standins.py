"""The driver's tables seen as sighting events, in Spark and in SQL.

``events`` become sightings: the user is the entity, ``props.k`` the year code, the event type
decides which defects a row has, so that every rule meets rows that break it:

* users ending in 0 have an entity that is too short, users ending in 1 one with a marker;
* ``error`` events have no feature and their JSON line is cut off; ``signup`` events have an
  empty feature, ``view`` events the text ``null``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.functions import timecodes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.lpad(F.col("user_id").cast("string"), 6, "0")
    last = F.col("user_id") % 10
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(
            F.when(last == 1, "E无").otherwise("E"),
            F.substring(user, F.when(last == 0, 3).when(last == 1, 2).otherwise(1), F.lit(6)),
        ).alias("entity"),
        timecodes.naive_seconds(F.col("ts")).alias("capture_time"),
        F.date_format("ts", timecodes.DIGIT_TIME).cast("bigint").alias("digits"),
        F.get_json_object("props", "$.k").cast("int").alias("year_id"),
        kind.alias("category"),
        F.floor("value").cast("int").alias("speed"),
        F.when(kind == "error", None).when(kind == "signup", "").when(kind == "view", "null")
        .otherwise(F.base64(F.unhex(F.md5(F.col("event_id").cast("string"))))).alias("feature"),
        F.concat(F.lit("N"), F.col("user_id") % 6).alias("node_id"),
        F.concat(F.lit("L"), F.col("user_id") % 25).alias("location_id"),
        F.when(kind == "click", 1).when(kind == "purchase", 2).otherwise(-1).alias("part_type"),
        "user_id",
    )


PASSES_SQL = """
ev as (
    select event_id as id,
        case when user_id % 10 = 0 then 'E' || right(lpad(cast(user_id as varchar), 6, '0'), 4)
             when user_id % 10 = 1 then 'E无' || right(lpad(cast(user_id as varchar), 6, '0'), 5)
             else 'E' || lpad(cast(user_id as varchar), 6, '0') end as entity,
        cast(epoch(date_trunc('second', ts)) as bigint) as capture_time,
        cast(strftime(ts, '%Y%m%d%H%M%S') as bigint) as digits,
        cast(regexp_extract(props, '[0-9]+') as integer) as year_id,
        event_type as category,
        cast(floor(value) as integer) as speed,
        case event_type when 'error' then null when 'signup' then '' when 'view' then 'null'
             else to_base64(unhex(md5(cast(event_id as varchar)))) end as feature,
        'N' || (user_id % 6) as node_id,
        'L' || (user_id % 25) as location_id,
        case event_type when 'click' then 1 when 'purchase' then 2 else -1 end as part_type,
        user_id, ts
    from events)
"""

VALID_SQL = (
    "(length(entity) between 6 and 10 and not contains(entity, '无') and not contains(entity, '未'))"
)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings as format 2 JSON lines in ``value``; those of ``error`` events are cut off."""
    head = F.concat(
        F.lit('{"id":"'), "id", F.lit('","plateNumber":"'), "entity", F.lit('","captureTime":'), "capture_time",
        F.lit(',"yearId":"'), "year_id", F.lit('","nodeId":"'), "node_id", F.lit('","locationId":"'), "location_id",
    )
    tail = F.concat(F.lit('","partType":'), "part_type", F.lit(',"speed":'), "speed", F.lit(',"extra":true}'))
    whole = F.when(F.col("category") == "error", "").otherwise(tail)
    return passes(spark, sf_dir).select(F.concat(head, whole).alias("value"))


LINES_SQL = """
lines as (
    select *, '{"id":"' || id || '","plateNumber":"' || entity || '","captureTime":' || capture_time
        || ',"yearId":"' || year_id || '","nodeId":"' || node_id || '","locationId":"' || location_id
        || case when category = 'error' then ''
           else '","partType":' || part_type || ',"speed":' || speed || ',"extra":true}' end as value
    from ev)
"""


def event_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings as format 1 rows; ``error`` events have no usable time."""
    return passes(spark, sf_dir).select(
        F.concat(F.lit("e"), "id").alias("id"),
        F.col("entity").alias("plateNumber"),
        F.when(F.col("category") == "error", 0).otherwise(F.col("digits")).alias("captureTime"),
        F.col("digits").alias("createTime"),
        F.concat(F.lit("D"), F.col("user_id") % 4).alias("directionId"),
        (F.col("year_id") % 12).alias("colorId"),
        (F.col("year_id") * 10).alias("modelId"),
        F.when(F.col("part_type") > 0, F.col("year_id")).otherwise(-1).alias("brandId"),
        F.col("part_type").alias("levelId"),
        F.col("year_id").alias("yearId"),
        "feature",
        F.col("location_id").alias("locationuuid"),
        F.col("speed").alias("lastCaptured"),
        F.when(F.col("category") != "signup", F.col("part_type")).alias("isSheltered"),
        (F.col("user_id") % 5).cast("int").alias("regionCode"),
    )


EVENT_V1_SQL = """
v1 as (
    select 'e' || id as id, entity as plateNumber,
        case when category = 'error' then 0 else digits end as captureTime,
        digits as createTime, 'D' || (user_id % 4) as directionId, year_id % 12 as colorId,
        year_id * 10 as modelId, case when part_type > 0 then year_id else -1 end as brandId,
        part_type as levelId, year_id as yearId, feature, location_id as locationuuid,
        speed as lastCaptured, case when category <> 'signup' then part_type end as isSheltered,
        cast(user_id % 5 as integer) as regionCode, category, ts, capture_time
    from ev)
"""

WAREHOUSE_SQL = """
wh as (
    select id as solrid, plateNumber as platenumber,
        case when category = 'error' then 0 else capture_time end as capturetime,
        -1 as directionid, colorId as colorid, modelId as modelid, brandId as brandid,
        levelId as levelid, yearId as yearid, feature as recfeature, locationuuid as locationid,
        lastCaptured as lastcaptured, isSheltered as issheltered, capture_time as createtime,
        regionCode as regioncode, directionId as direction,
        case when category = 'error' then 0 else cast(strftime(ts, '%Y%m%d') as integer) end as dateid
    from v1)
"""


def with_(*parts: str, recursive: bool = False) -> str:
    return ("with recursive " if recursive else "with ") + ",".join(p.strip() for p in parts)
