"""Dimension lookups, reconciliation, aggregations and similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import schemas, session
from sightline.functions import timecodes, vectors
from sightline.operators import aggregates, digests, enrich, reconcile, sketches
from sightline.operators import similarity as sim
from sightline.plans import standins as st
from sightline.plans.registry import query
from sightline.sources import batch
from sightline.streaming.run import Batch

EV = st.with_(st.PASSES_SQL)


def _category_dim(spark, sf):
    """part as the year dimension: year -> (brand code, model code)."""
    return st.table(spark, sf, "part").select(
        F.col("p_partkey").alias("year"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("brand_id"),
        F.col("p_size").alias("model_id"),
    )


CATEGORY_DIM_SQL = """
years as (select p_partkey as year, cast(split_part(p_brand, '#', 2) as integer) as brand_id,
    p_size as model_id from part)
"""


@query("dim_scan", """
select p_partkey as year, p_brand as brand, p_type as model from part""")
def dim_scan(spark, sf):
    return batch.dimension(
        spark, f"{sf.rstrip('/')}/part.parquet", {"year": "p_partkey", "brand": "p_brand", "model": "p_type"}
    )


@query("enrich_category", st.with_(CATEGORY_DIM_SQL) + """
select l_orderkey, l_linenumber, l_partkey * 2 as year, coalesce(brand_id, -1) as brand_id,
    coalesce(model_id, -1) as model_id
from lineitem left join years on year = l_partkey * 2 and l_partkey <> 0""")
def enrich_category(spark, sf):
    facts = st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 2).alias("raw_year"),
    )
    keyed = facts.withColumn("year", enrich.masked_key(F.col("raw_year")))
    found = enrich.lookup(keyed, _category_dim(spark, sf), ["year"], {"brand_id": -1, "model_id": -1})
    return found.select("l_orderkey", "l_linenumber", F.col("raw_year").alias("year"), "brand_id", "model_id")


@query("enrich_region", """
select event_id as id, user_id % 6 as node_id, user_id % 25 as loc_id,
    coalesce(n_nationkey + 100, 0) as region_code
from events left join nation on n_regionkey = user_id % 6 and n_nationkey = user_id % 25""")
def enrich_region(spark, sf):
    facts = st.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 6).alias("node_id"),
        (F.col("user_id") % 25).alias("loc_id"),
    )
    dim = st.table(spark, sf, "nation").select(
        F.col("n_regionkey").cast("bigint").alias("node_id"), F.col("n_nationkey").cast("bigint").alias("loc_id"),
        (F.col("n_nationkey") + 100).alias("region_code"),
    )
    return enrich.lookup(facts, dim, ["node_id", "loc_id"], {"region_code": 0})


@query("enrich_type", """
select c_custkey, c_nationkey % 8 as plate_category, coalesce(length(r_name), -1) as plate_type
from customer left join region on r_regionkey = c_nationkey % 8""")
def enrich_type(spark, sf):
    facts = st.table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") % 8).alias("plate_category"))
    dim = st.table(spark, sf, "region").select(
        F.col("r_regionkey").alias("plate_category"), F.length("r_name").cast("bigint").alias("plate_type")
    )
    return enrich.lookup(facts, dim, ["plate_category"], {"plate_type": -1})


@query("enrich_conditional", """
with sides as (select case when p_size % 2 = 1 then 1 else 2 end as part_type, p_partkey as year,
    cast(split_part(p_brand, '#', 2) as integer) as brand_id, p_size as model_id from part)
select l_orderkey, l_linenumber, l_linenumber % 3 as part_type, l_partkey as year,
    coalesce(brand_id, -1) as brand_id, coalesce(model_id, -1) as model_id
from lineitem left join sides on sides.part_type = l_linenumber % 3 and year = l_partkey""")
def enrich_conditional(spark, sf):
    facts = st.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") % 3).alias("part_type"), F.col("l_partkey").alias("year")
    )
    dim = _category_dim(spark, sf)
    odd = F.col("model_id") % 2 == 1
    dims = {schemas.PART_HEAD: dim.filter(odd), schemas.PART_TAIL: dim.filter(~odd)}
    return enrich.lookup_by_part(facts, dims, "part_type", ["year"], {"brand_id": -1, "model_id": -1})


@query("reconcile_missing", """
select coalesce(o.k, l.k) as order_key, coalesce(o.n, 0) as n_primary, coalesce(l.n, 0) as n_shadow
from (select o_orderkey as k, count(*) as n from orders group by 1) o
full join (select l_orderkey as k, count(*) as n from lineitem group by 1) l on o.k = l.k
where o.k is null or l.k is null""")
def reconcile_missing(spark, sf):
    primary = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"))
    shadow = st.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return reconcile.missing(primary, shadow, "order_key")


@query("reconcile_digest", """
select coalesce(o.k, l.k) as order_key, coalesce(o.n, 0) as n_primary, coalesce(l.n, 0) as n_shadow
from (select o_orderkey as k, count(*) as n from orders group by 1) o
full join (select l_orderkey as k, count(*) as n from lineitem group by 1) l on o.k = l.k
where o.k is null or l.k is null""")
def reconcile_digest(spark, sf):
    """The same rows by digests per range of keys and bucket, drilled into where they differ."""
    root, sides = session.scratch_path(spark, "reconcile"), []
    for name, column in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        rows = st.table(spark, sf, name).select(F.col(column).alias("order_key"), F.floor(F.col(column) / 4096).cast("int").alias("part"))
        digests.store(rows, f"{root}/{name}", "order_key", "part", 8)
        sides.append(digests.read(spark, f"{root}/{name}", rows.withColumn("bucket", F.lit(0))))
    return digests.missing(*sides, f"{root}/orders", f"{root}/lineitem", "order_key", "part")


#: Days that a rolling count goes back, the day itself included.
ROLLING = 7


@query("agg_distinct_rolling", f"""
with d as (select distinct cast(ts as date) as day, user_id from events)
select cast(strftime(a.day, '%Y%m%d') as integer) as dateid, count(distinct b.user_id) as n_exact, true as within_error
from (select distinct day from d) a join d b on b.day between a.day - interval {ROLLING - 1} day and a.day group by 1""")
def agg_distinct_rolling(spark, sf):
    """Sketches of two batches, merged; the exact count is stated beside, with whether the estimate is within the error."""
    rows = st.table(spark, sf, "events").select(F.date_format("ts", "yyyyMMdd").cast("int").alias("dateid"), "user_id")
    table = sketches.DaySketches(session.scratch_path(spark, "sketches"))
    early = F.col("dateid") <= 20240115
    for number, part in enumerate((rows.filter(early), rows.filter(~early), rows.filter(~early))):
        table.add(part, "dateid", "user_id", Batch("load", min(number, 1)))  # the last one is known
    exact = sketches.exact_rolling(rows, "dateid", "user_id", ROLLING)
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.ceil(F.col("n_exact") * sketches.ERROR)
    return table.rolling(spark, ROLLING).join(exact, "day").select(F.col("day").alias("dateid"), "n_exact", near.alias("within_error"))


@query("agg_count_star", "select count(*) as n_rows from lineitem")
def agg_count_star(spark, sf):
    return aggregates.row_count(st.table(spark, sf, "lineitem"))


@query("agg_group_keys", """
select cast(strftime(l_shipdate, '%Y%m%d') as integer) as dateid, l_suppkey, count(*) as n_rows
from lineitem group by 1, 2""")
def agg_group_keys(spark, sf):
    rows = st.table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("dateid"), "l_suppkey"
    )
    return aggregates.group_keys(rows, "dateid", "l_suppkey")


@query("agg_distinct_daily", """
select cast(strftime(ts, '%Y%m%d') as integer) as dateid, count(distinct user_id) as n_entities
from events group by 1""")
def agg_distinct_daily(spark, sf):
    rows = st.table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").cast("int").alias("dateid"), "user_id"
    )
    return aggregates.distinct_per_day(rows, "dateid", "user_id")


@query("agg_by_location", EV + """
select location_id, count(*) as n_rows, min(capture_time) as first_time, max(capture_time) as last_time,
    count(distinct entity) as n_entities from ev group by 1""")
def agg_by_location(spark, sf):
    rows = st.passes(spark, sf).select("location_id", "capture_time", "entity")
    return aggregates.per_group(rows, "location_id", "capture_time", "entity")


# --- similarity ----------------------------------------------------------------------------

DISTANCE_SQL = (
    "round(list_sum(list_transform(list_zip({a}, {b}), "
    "lambda p: (cast(p[1] as double) - cast(p[2] as double)) * (cast(p[1] as double) - cast(p[2] as double)))), 6)"
)


def _vectors(spark, sf):
    return st.table(spark, sf, "embeddings").select(
        F.col("label").alias("category"), "vec_id", F.col("embedding").alias("vector")
    )


@query("topk_similar", f"""
with q as (select label, embedding as qe from embeddings order by vec_id limit 1)
select vec_id, {DISTANCE_SQL.format(a='qe', b='embedding')} as similarity
from embeddings e join q on e.label = q.label order by similarity, vec_id limit 100""")
def topk_similar(spark, sf):
    table = _vectors(spark, sf)
    one = sim.first_row(table, "vec_id").select("category", F.col("vector").alias("query_vector"))
    return sim.nearest_to_one(one, table, ["category"], "query_vector", "vec_id", "vector", digits=6)


@query("topk_similar_batch", f"""
with q as (select label, vec_id as query_id, embedding as qe from embeddings
    qualify row_number() over (partition by label order by vec_id) = 1),
scored as (select query_id, vec_id, {DISTANCE_SQL.format(a='qe', b='embedding')} as similarity
    from embeddings e join q on e.label = q.label)
select query_id, vec_id, similarity, position from (
    select *, cast(row_number() over (partition by query_id order by similarity, vec_id) as integer) as position
    from scored) where position <= 10""")
def topk_similar_batch(spark, sf):
    table = _vectors(spark, sf)
    queries = sim.first_per_category(table, ["category"], "vec_id", "vector")
    return sim.top_k(queries, table, ["category"], "query_id", "query_vector", "vec_id", "vector", k=10, digits=6)


BYTES_SQL = EV + """,
h as (select id, category, hex(from_base64(feature)) as f from ev
    where feature is not null and feature <> '' and feature <> 'null'),
q as (select category, f as qf, id as query_id from h
    qualify row_number() over (partition by category order by id) = 1),
scored as (select query_id, h.category, id, cast(list_sum(list_transform(range(16),
    lambda i: pow(cast('0x' || substr(f, 2 * i + 1, 2) as integer)
                - cast('0x' || substr(qf, 2 * i + 1, 2) as integer), 2))) as bigint) as similarity
    from h join q on h.category = q.category)
"""


def _features(spark, sf):
    rows = st.passes(spark, sf).select("id", "category", "feature")
    return rows.filter(F.col("feature").isNotNull())


@query("topk_similar_bytes", BYTES_SQL + """
select query_id, id, similarity, position from (
    select *, cast(row_number() over (partition by query_id order by similarity, id) as integer) as position
    from scored) where position <= 100""")
def topk_similar_bytes(spark, sf):
    table = _features(spark, sf).filter((F.col("feature") != "") & (F.col("feature") != "null"))
    queries = sim.first_per_category(table, ["category"], "id", "feature")
    return sim.top_k(
        queries, table, ["category"], "query_id", "query_vector", "id", "feature", distance=vectors.byte_distance
    )


@query("topk_similar_udf", BYTES_SQL + """
select id, similarity from scored where query_id = (select min(query_id) from scored)
order by similarity, id limit 100""")
def topk_similar_udf(spark, sf):
    table = _features(spark, sf)
    usable = table.filter((F.col("feature") != "") & (F.col("feature") != "null"))
    one = sim.first_row(usable, "id").select("category", "feature")
    return sim.nearest_by_sql(spark, one, table)
