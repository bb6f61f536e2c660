"""Cells, lists, documents and table sinks; every sink query reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline import schemas, session
from sightline.functions import keys, timecodes
from sightline.operators import cells, documents, lists, project
from sightline.plans import standins as st
from sightline.plans.registry import query
from sightline.plans.scans import DAY_ROWS_SQL, DAY_SQL, EV, day_rows
from sightline.plans.transforms import BYTE_SUM_SQL, TIE_SQL, UUID_SQL, WH
from sightline.sinks import indexes, messages, tables
from sightline.streaming.run import Batch


def warehouse(spark, sf):
    return project.warehouse_row(st.event_v1(spark, sf))


# --- cells -----------------------------------------------------------------------------------

PACKED_SQL = " || '_' || ".join(
    "coalesce(cast(issheltered as varchar), 'null')" if f == "issheltered" else f for f in schemas.PACKED_PASS_FIELDS
)
TIE3_SQL = f"lpad(cast({TIE_SQL.format(c='solrid')} as varchar), 3, '0')"


@query("index_location_time", WH + f"""
select locationid || '_' || capturetime as rowkey, 'pass' as qualifier,
    cast(capturetime || lpad(cast(yearid as varchar), 4, '0') || {TIE3_SQL} as bigint) as version,
    {PACKED_SQL} as value from wh""")
def index_location_time(spark, sf):
    return cells.location_time_index(warehouse(spark, sf))


@query("index_category_hour", WH + f""",
named as (select *, md5(yearid || '_' || case when capturetime = 0 then '1970010100'
        else strftime(make_timestamp(capturetime * 1000000), '%Y%m%d%H') end) as m
    from wh where recfeature is not null and recfeature <> '')
select {UUID_SQL.format(m='m')} as rowkey, 'yearids' as qualifier,
    cast(capturetime || {TIE3_SQL} || lpad(cast({BYTE_SUM_SQL.format(f='recfeature')} % 1000 as varchar), 3, '0')
        as bigint) as version,
    recfeature || '_' || platenumber || '_' || solrid || '_' || capturetime as value
from named""")
def index_category_hour(spark, sf):
    return cells.category_hour_index(warehouse(spark, sf))


CUSTOMER_COLUMNS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("cells_unpivot", """
select cast(c_custkey as varchar) as rowkey, unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) as qualifier,
    c_custkey + 1000 as version,
    unnest([c_name, cast(c_nationkey as varchar), cast(cast(c_acctbal as decimal(12, 2)) as varchar), c_mktsegment]) as value
from customer""")
def cells_unpivot(spark, sf):
    rows = st.table(spark, sf, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    return cells.to_cells(rows.withColumn("version", F.col("c_custkey") + 1000), "c_custkey", "version", CUSTOMER_COLUMNS)


ORDER_CELLS_SQL = """
oc as (select reverse(lpad(cast(o_custkey as varchar), 8, '0')) as rowkey,
    cast(strftime(o_orderdate, '%Y%m%d') as bigint) * 100000000 + o_orderkey as version,
    o_orderstatus, o_orderpriority from orders)
"""


def _order_cells(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        keys.reverse_key(keys.zero_pad(F.col("o_custkey"), 8)).alias("rowkey"),
        (F.date_format("o_orderdate", "yyyyMMdd").cast("bigint") * 100_000_000 + F.col("o_orderkey")).alias("version"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
    )
    return cells.to_cells(rows, "rowkey", "version", ["status", "priority"])


@query("cells_latest", st.with_(ORDER_CELLS_SQL) + """
select rowkey, arg_max(o_orderstatus, version) as status, arg_max(o_orderpriority, version) as priority
from oc group by 1""")
def cells_latest(spark, sf):
    return cells.latest(_order_cells(spark, sf), ["status", "priority"])


@query("cells_all_versions", st.with_(ORDER_CELLS_SQL) + """
select rowkey, unnest(['status', 'priority']) as qualifier, version,
    unnest([o_orderstatus, o_orderpriority]) as value
from oc where rowkey in (select reverse(lpad(cast(c_custkey as varchar), 8, '0')) from customer
    where c_mktsegment = 'BUILDING')""")
def cells_all_versions(spark, sf):
    wanted = st.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        keys.zero_pad(F.col("c_custkey"), 8).alias("key")
    )
    return cells.all_versions(_order_cells(spark, sf), wanted, "key")


# --- lists -----------------------------------------------------------------------------------

@query("list_by_key", WH + """
select list_key, position, value from (
    select dateid || '_' || yearid as list_key,
        recfeature || '_' || platenumber || '_' || solrid || '_' || capturetime as value,
        row_number() over (partition by dateid, yearid order by capturetime desc, solrid desc) - 1 as position
    from wh where recfeature is not null and recfeature <> '')""")
def list_by_key(spark, sf):
    rows = warehouse(spark, sf).filter(F.col("recfeature").isNotNull() & (F.col("recfeature") != ""))
    return lists.pushed(
        rows, keys.packed(F.col("dateid"), F.col("yearid")),
        keys.packed(F.col("recfeature"), F.col("platenumber"), F.col("solrid"), F.col("capturetime")),
        [F.col("capturetime"), F.col("solrid")],
    )


# --- documents ---------------------------------------------------------------------------------

DOC_BODY_SQL = (
    "'{\"A001\":' || o_orderkey || ',\"A002\":' || o_custkey || ',\"A007\":\"' || o_orderstatus || '\"' "
    "|| case when o_orderstatus <> 'F' then ',\"A015\":\"' || o_orderpriority || '\"' else '' end || '}'"
)


_DOC_BODY = T.StructType([
    T.StructField("A001", T.LongType()), T.StructField("A002", T.LongType()), T.StructField("A007", T.StringType()),
    T.StructField("A015", T.StringType()),
])
#: Buckets of an index here; its documents are few.
DOC_BUCKETS = 2


def _order_docs(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("A001"), F.col("o_custkey").alias("A002"), F.col("o_orderstatus").alias("A007"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("A015"),
        timecodes.naive_seconds(F.col("o_orderdate")).alias("seconds"),
    )
    index = F.concat(F.lit("pass"), timecodes.month_tag(F.col("seconds")))
    return documents.to_documents(rows, "A001", index, F.col("seconds"), ["A001", "A002", "A007", "A015"])


#: What the patch of doc_index_monthly leaves of DOC_BODY_SQL: orders of a priority get it spelt otherwise.
PATCHED_SQL = DOC_BODY_SQL.replace(
    "o_orderpriority ||", "case when o_orderkey % 7 = 0 then 'checked' else o_orderpriority end ||"
)


@query("doc_index_monthly", f"""
select 'pass' || strftime(o_orderdate, '%Y%m') as index_name, cast(o_orderkey as varchar) as doc_id,
    cast(epoch(date_trunc('second', o_orderdate)) as bigint) as version, {PATCHED_SQL} as body from orders""")
def doc_index_monthly(spark, sf):
    """Two loads that overlap, a patch of one field in every seventh document, and a compaction after each."""
    path = session.scratch_path(spark, "docs")
    docs = _order_docs(spark, sf)
    number = F.col("doc_id").cast("bigint")
    indexes.write_monthly(docs.filter(number % 3 != 0), Batch("load", 0), path, DOC_BUCKETS)
    indexes.compact(spark, path)
    indexes.write_monthly(docs.filter(number % 3 != 1), Batch("load", 1), path, DOC_BUCKETS)
    patches = docs.filter((number % 7 == 0) & F.contains("body", F.lit('"A015"'))).select(
        "index_name", "doc_id", "version", F.lit("checked").alias("A015")
    )
    indexes.patch_monthly(patches, _DOC_BODY, Batch("patch", 0), path)
    indexes.compact(spark, path)
    return indexes.read(spark, path)


@query("doc_index_fixed", """
with docs as (select l_orderkey || '_' || l_linenumber as doc_id,
    cast(epoch(date_trunc('second', l_shipdate)) as bigint) as version,
    '{"doc_id":"' || l_orderkey || '_' || l_linenumber || '","part":' || l_partkey || ',"supplier":' || l_suppkey
    || ',"flag":"' || l_returnflag || '"}' as body from lineitem)
select 'pass' as index_name, doc_id, version, body from docs
qualify row_number() over (partition by doc_id order by version desc, body desc) = 1""")
def doc_index_fixed(spark, sf):
    rows = st.table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("doc_id"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag"),
        timecodes.naive_seconds(F.col("l_shipdate")).alias("shipped"),
    )
    docs = documents.to_documents(
        rows, "doc_id", F.lit("pass"), F.col("shipped"), ["doc_id", "part", "supplier", "flag"]
    )
    return documents.upsert(docs)


@query("doc_patch", """
with p as (select o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) as pri from orders group by 1)
select c_custkey, c_name, coalesce(pri, c_mktsegment) as c_mktsegment, c_nationkey
from customer left join p on o_custkey = c_custkey""")
def doc_patch(spark, sf):
    patches = st.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"), "o_orderdate", "o_orderkey"
    )
    base = st.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    newest = documents.latest_patch(patches, "c_custkey", ["o_orderdate", "o_orderkey"])
    return documents.patch(base, newest, "c_custkey")


@query("republish_json", EV + """
select '{"id":' || id || ',"entity":"' || entity || '","capture_time":' || capture_time
    || case when feature is not null then ',"feature":"' || feature || '"' else '' end || '}' as value from ev""")
def republish_json(spark, sf):
    path = session.scratch_path(spark, "topic")
    messages.publish_files(st.passes(spark, sf).select("id", "entity", "capture_time", "feature"), path)
    return spark.read.text(path)


# --- tables ------------------------------------------------------------------------------------

@query("sink_partitioned_insert", WH + "select solrid, platenumber, capturetime, brandid, createtime, dateid from wh")
def sink_partitioned_insert(spark, sf):
    rows = warehouse(spark, sf)
    path = session.scratch_path(spark, "warehouse")
    name = tables.create(spark, "warehouse_" + path.rsplit("-", 1)[1], rows, path, ["dateid"])
    tables.insert(spark, name, rows, ["dateid"])
    return spark.table(name).select("solrid", "platenumber", "capturetime", "brandid", "createtime", "dateid")


@query("sink_two_level_partition", EV + f"""
select id, entity, {DAY_SQL} as dateid, category, true as in_its_folder from ev""")
def sink_two_level_partition(spark, sf):
    rows = st.passes(spark, sf).select("id", "entity", timecodes.day_of(F.col("capture_time")).alias("dateid"), "category")
    path = session.scratch_path(spark, "two-level")
    tables.append(rows, path, ["dateid", "category"])
    folder = F.concat(F.lit("/dateid="), F.col("dateid"), F.lit("/category="), F.col("category"), F.lit("/"))
    return spark.read.parquet(path).select(
        "id", "entity", "dateid", "category", F.contains(F.col("_metadata.file_path"), folder).alias("in_its_folder")
    )


@query("sink_gzip_distribute", EV + f"""
select id, entity, capture_time, dateid, location_id, 'gz' as codec from ({DAY_ROWS_SQL})""")
def sink_gzip_distribute(spark, sf):
    path = session.scratch_path(spark, "gzip")
    tables.append(day_rows(spark, sf), path, ["dateid"], spread_on=["location_id"], compression="gzip")
    codec = F.regexp_extract(F.col("_metadata.file_name"), r"\.([a-z]+)\.parquet$", 1)
    return spark.read.parquet(path).select("id", "entity", "capture_time", "dateid", "location_id", codec.alias("codec"))
