"""Scalar functions, decoding, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import schemas
from sightline.functions import keys, timecodes, vectors
from sightline.operators import decode, filters, project
from sightline.operators import similarity as sim
from sightline.plans import standins as st
from sightline.plans.registry import query

NOW = "2024-02-01 00:00:00"


def _digits():
    """Digit times with each way of not being one: month 13, empty, zero."""
    kind, text = F.col("category"), F.col("digits").cast("string")
    return (
        F.when(kind == "error", F.concat(F.left(text, F.lit(4)), F.lit("13"), F.substring(text, 7, 8)))
        .when(kind == "signup", "").when(kind == "view", "0").otherwise(text)
    )


EV = st.with_(st.PASSES_SQL)
GOOD = "category in ('click', 'purchase')"


@query("fn_epoch", EV + f"""
select id, case when {GOOD} then capture_time else 0 end as epoch_s from ev""")
def fn_epoch(spark, sf):
    return st.passes(spark, sf).select("id", timecodes.epoch_seconds(_digits()).alias("epoch_s"))


@query("fn_dateid", EV + f"""
select id, case when {GOOD} then cast(strftime(ts, '%Y%m%d') as integer) else 0 end as dateid from ev""")
def fn_dateid(spark, sf):
    return st.passes(spark, sf).select("id", timecodes.day_id(_digits()).alias("dateid"))


@query("fn_timestamp", EV + f"""
select id, case when {GOOD} then strftime(ts, '%Y-%m-%d %H:%M:%S') end as at,
    case when {GOOD} then strftime(ts, '%Y-%m-%d') end as on_day from ev""")
def fn_timestamp(spark, sf):
    return st.passes(spark, sf).select(
        "id",
        F.date_format(timecodes.parse_time(_digits()), "yyyy-MM-dd HH:mm:ss").alias("at"),
        timecodes.parse_date(_digits()).cast("string").alias("on_day"),
    )


@query("fn_hour_bucket", EV + "select id, strftime(ts, '%Y%m%d%H') as hour_tag from ev")
def fn_hour_bucket(spark, sf):
    return st.passes(spark, sf).select("id", timecodes.hour_tag(F.col("capture_time")).alias("hour_tag"))


@query("fn_month", """
select o_orderkey, case when o_orderstatus = 'P' then '202402'
    else strftime(o_orderdate, '%Y%m') end as month_tag from orders""")
def fn_month(spark, sf):
    seconds = timecodes.naive_seconds(F.col("o_orderdate"))
    known = F.when(F.col("o_orderstatus") == "P", 0).otherwise(seconds)
    now = F.lit(NOW).cast("timestamp")
    return st.table(spark, sf, "orders").select(
        "o_orderkey", timecodes.month_tag(known, now).alias("month_tag")
    )


@query("fn_day_shift", """
select o_orderkey,
    strftime(o_orderdate - interval 1 day, '%Y%m%d') as yesterday,
    strftime(o_orderdate - interval 10 day, '%Y%m%d') as ten_back,
    strftime(o_orderdate - interval 30 day, '%Y%m%d') as month_back,
    strftime(o_orderdate + interval 1 day, '%Y%m%d%H') as next_hour_tag,
    strftime(o_orderdate, '%Y-%m-%d') as reformatted
from orders""")
def fn_day_shift(spark, sf):
    day = F.to_date("o_orderdate")
    return st.table(spark, sf, "orders").select(
        "o_orderkey",
        timecodes.shift_day(day, -1).alias("yesterday"),
        timecodes.shift_day(day, -10).alias("ten_back"),
        timecodes.shift_day(day, -30).alias("month_back"),
        timecodes.shift_hour_tag(F.date_format("o_orderdate", "yyyyMMddHH"), 1).alias("next_hour_tag"),
        timecodes.reformat(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd", "yyyy-MM-dd").alias("reformatted"),
    )


UUID_SQL = (
    "substr({m}, 1, 12) || '3' || substr({m}, 14, 3) || substr('89ab89ab89ab89ab', "
    "strpos('0123456789abcdef', substr({m}, 17, 1)), 1) || substr({m}, 18, 15)"
)


@query("fn_name_uuid", f"""
with named as (select o_orderkey, md5(o_custkey || '_' || o_orderkey) as m from orders)
select o_orderkey, {UUID_SQL.format(m='m')} as uuid from named""")
def fn_name_uuid(spark, sf):
    name = keys.packed(F.col("o_custkey"), F.col("o_orderkey"))
    return st.table(spark, sf, "orders").select("o_orderkey", keys.name_uuid(name).alias("uuid"))


@query("fn_zero_pad", """
select p_partkey, lpad(cast(p_size as varchar), 3, '0') as size3,
    lpad(cast(p_size as varchar), 4, '0') as size4,
    case when length(cast(p_partkey as varchar)) >= 3 then cast(p_partkey as varchar)
         else lpad(cast(p_partkey as varchar), 3, '0') end as key3
from part""")
def fn_zero_pad(spark, sf):
    return st.table(spark, sf, "part").select(
        "p_partkey", keys.zero_pad(F.col("p_size"), 3).alias("size3"),
        keys.zero_pad(F.col("p_size"), 4).alias("size4"), keys.zero_pad(F.col("p_partkey"), 3).alias("key3"),
    )


TIE_SQL = "cast(cast('0x' || substr(md5(cast({c} as varchar)), 1, 6) as integer) % 999 as integer)"


@query("fn_tiebreak", f"select o_orderkey, {TIE_SQL.format(c='o_orderkey')} as tiebreak from orders")
def fn_tiebreak(spark, sf):
    return st.table(spark, sf, "orders").select(
        "o_orderkey", keys.tiebreak(F.col("o_orderkey").cast("string")).alias("tiebreak")
    )


BYTE_SUM_SQL = (
    "coalesce(list_sum(list_transform(range(cast(octet_length(from_base64({f})) as bigint)), "
    "lambda i: cast('0x' || substr(hex(from_base64({f})), 2 * i + 1, 2) as integer))), 0)"
)


@query("fn_byte_checksum", EV + f"""
select id, cast(case when feature is not null then {BYTE_SUM_SQL.format(f='feature')} end as bigint) as byte_sum,
    cast(case when feature is not null then {BYTE_SUM_SQL.format(f='feature')} % 1000 end as bigint) as checksum
from ev""")
def fn_byte_checksum(spark, sf):
    return st.passes(spark, sf).select(
        "id", vectors.byte_sum(F.col("feature")).alias("byte_sum"),
        vectors.byte_checksum(F.col("feature")).alias("checksum"),
    )


@query("fn_version", EV + f"""
select id, cast(capture_time || lpad(cast(year_id as varchar), 4, '0')
    || lpad(cast({TIE_SQL.format(c='id')} as varchar), 3, '0') as bigint) as version from ev""")
def fn_version(spark, sf):
    tie = keys.zero_pad(keys.tiebreak(F.col("id").cast("string")), 3)
    return st.passes(spark, sf).select(
        "id", keys.version_of(F.col("capture_time"), keys.zero_pad(F.col("year_id"), 4), tie).alias("version")
    )


@query("fn_reverse_key", EV + "select id, reverse(entity) as rowkey from ev")
def fn_reverse_key(spark, sf):
    return st.passes(spark, sf).select("id", keys.reverse_key(F.col("entity")).alias("rowkey"))


@query("fn_bucket", """
select c_custkey, (c_nationkey - 12) % 10 as bucket10, c_custkey % 100 as bucket100 from customer""")
def fn_bucket(spark, sf):
    return st.table(spark, sf, "customer").select(
        "c_custkey", keys.bucket(F.col("c_nationkey") - 12, 10).alias("bucket10"),
        keys.bucket(F.col("c_custkey"), 100).alias("bucket100"),
    )


@query("parse_csv_query", EV + """
select feature, year_id as model_id, case when category = 'click' then speed end as brand_id
from ev where feature is not null""")
def parse_csv_query(spark, sf):
    brand = F.when(F.col("category") == "click", F.col("speed").cast("string")).otherwise("x")
    lines = st.passes(spark, sf).filter(F.col("feature").isNotNull()).select(
        F.concat_ws(",", "feature", F.col("year_id").cast("string"), brand).alias("value")
    )
    return sim.parse_queries(lines)


@query("json_decode", st.with_(st.PASSES_SQL) + """
select cast(id as varchar) as id, entity as plateNumber, capture_time as captureTime, year_id as yearId,
    node_id as nodeId, location_id as locationId, part_type as partType, speed,
    cast(null as varchar) as directionId
from ev where category <> 'error'""")
def json_decode(spark, sf):
    rows = decode.valid(decode.decode_json(st.lines(spark, sf), schemas.EVENT_V2))
    return rows.select(
        "id", "plateNumber", "captureTime", "yearId", "nodeId", "locationId", "partType", "speed", "directionId"
    )


@query("json_quarantine", st.with_(st.PASSES_SQL, st.LINES_SQL) + """
select value from lines where category = 'error'
union all select text as value from conversations where text <> ''""")
def json_quarantine(spark, sf):
    talk = st.table(spark, sf, "conversations").select(F.col("text").alias("value"))
    lines = st.lines(spark, sf).unionByName(talk)
    return decode.quarantine(decode.decode_json(lines, schemas.EVENT_V2))


@query("filter_nonblank", """
select id, value from (select event_id as id,
    case event_type when 'signup' then '' when 'view' then '   ' else props end as value from events)
where value <> ''""")
def filter_nonblank(spark, sf):
    kind = F.col("event_type")
    return decode.nonempty(
        st.table(spark, sf, "events").select(
            F.col("event_id").alias("id"),
            F.when(kind == "signup", "").when(kind == "view", "   ").otherwise(F.col("props")).alias("value"),
        )
    )


@query("filter_valid_entity", EV + f"select id, entity, capture_time from ev where {st.VALID_SQL}")
def filter_valid_entity(spark, sf):
    rows = st.passes(spark, sf).select("id", "entity", "capture_time")
    return rows.filter(filters.valid_entity(F.col("entity"), F.col("capture_time")))


@query("filter_feature_present", EV + """
select id, feature, feature <> 'null' as searchable from ev where feature is not null and feature <> ''""")
def filter_feature_present(spark, sf):
    rows = filters.present_features(st.passes(spark, sf).select("id", "feature"), "feature")
    return rows.select("id", "feature", filters.feature_present(F.col("feature"), True).alias("searchable"))


V1 = st.with_(st.PASSES_SQL, st.EVENT_V1_SQL)
WH = st.with_(st.PASSES_SQL, st.EVENT_V1_SQL, st.WAREHOUSE_SQL)


@query("project_warehouse", WH + "select * from wh")
def project_warehouse(spark, sf):
    return project.warehouse_row(st.event_v1(spark, sf))


@query("project_bucketed", WH + "select *, brandid % 10 as brandpartition from wh")
def project_bucketed(spark, sf):
    return project.warehouse_row(st.event_v1(spark, sf), buckets=10)


@query("project_prune", WH + f"select {', '.join(schemas.INDEX_COLUMNS)} from wh")
def project_prune(spark, sf):
    return project.index_columns(project.warehouse_row(st.event_v1(spark, sf)))


def _wide(df, ddl: str):
    """Add the fields of a feed format that a row lacks, as NULL."""
    fields = schemas.event_type(ddl).fields
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


_V1_GIVEN = {
    "id", "plateNumber", "captureTime", "createTime", "directionId", "colorId", "modelId", "brandId",
    "levelId", "yearId", "feature", "locationuuid", "lastCaptured", "isSheltered", "regionCode",
}
_V1_TEXT = {"carBox", "imageUrl", "recPlateNumber", "locationId"}


def _coded_sql() -> str:
    parts = []
    for code, field in schemas.ROW_STORE_V1.items():
        if field is None or field in _V1_TEXT:
            parts.append(f"'' as {code}")
        elif field == "feature":
            parts.append(f"coalesce(feature, '') as {code}")
        elif field in _V1_GIVEN:
            parts.append(f"{'coalesce(isSheltered, -1)' if field == 'isSheltered' else field} as {code}")
        else:
            parts.append(f"-1 as {code}")
    return ", ".join(parts)


@query("project_coded", V1 + f"select {_coded_sql()} from v1")
def project_coded(spark, sf):
    rows = _wide(st.event_v1(spark, sf), schemas.EVENT_V1)
    full = project.default_nulls(rows, region=schemas.UNKNOWN_REGION_V1)
    return project.coded(full, schemas.ROW_STORE_V1)


_V2_GIVEN = {
    "id": "cast(id as varchar)", "plateNumber": "entity",
    "captureTime": "case when category = 'error' then 1706745600 else capture_time end",
    "yearId": "year_id", "nodeId": "node_id", "locationId": "location_id", "partType": "part_type",
    "speed": "case when category = 'view' then -1 else speed end", "feature": "coalesce(feature, '')",
    "sendTime": "1706745600", "regionCode": "0", "yearIdProb": "0.0",
}


def _defaults_sql() -> str:
    parts = []
    for name, kind in schemas.fields_of(schemas.EVENT_V2):
        kind = "varchar" if kind == "string" else kind
        value = _V2_GIVEN.get(name, "''" if kind == "varchar" else "-1")
        parts.append(f"cast({value} as {kind}) as {name}")
    return ", ".join(parts)


@query("default_nulls", EV + f"select {_defaults_sql()} from ev")
def default_nulls(spark, sf):
    return _defaulted(spark, sf)


def _coded_v2_sql() -> str:
    return ", ".join(f"{field} as {code}" for code, field in schemas.ROW_STORE_V2.items())


@query("project_coded_v2", EV + f", full_rows as (select {_defaults_sql()} from ev) select {_coded_v2_sql()} from full_rows")
def project_coded_v2(spark, sf):
    return project.coded(_defaulted(spark, sf), schemas.ROW_STORE_V2)


def _defaulted(spark, sf):
    rows = st.passes(spark, sf)
    given = rows.select(
        F.col("id").cast("string").alias("id"), F.col("entity").alias("plateNumber"),
        F.when(F.col("category") != "error", F.col("capture_time")).alias("captureTime"),
        F.col("year_id").alias("yearId"), F.col("node_id").alias("nodeId"),
        F.col("location_id").alias("locationId"), F.col("part_type").alias("partType"),
        F.when(F.col("category") != "view", F.col("speed")).alias("speed"), "feature",
    )
    return project.default_nulls(_wide(given, schemas.EVENT_V2), now=F.lit(NOW).cast("timestamp"))
