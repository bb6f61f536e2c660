"""Last-seen, lateness, neighbours and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import schemas
from sightline.functions import timecodes
from sightline.operators import asof, filters, lastseen
from sightline.plans import standins as st
from sightline.plans.registry import query

EV = st.with_(st.PASSES_SQL)

FOLD_SQL = st.PASSES_SQL + f""",
ranked as (select id, entity, capture_time,
    row_number() over (partition by entity order by capture_time, id) as rn from ev where {st.VALID_SQL}),
walk as (
    select entity, id, rn, capture_time as ct, cast(0 as bigint) as lt, cast(0 as bigint) as last_captured
    from ranked where rn = 1
    union all
    select r.entity, r.id, r.rn,
        case when r.capture_time > w.ct and w.lt <> 0 and r.capture_time - w.ct + w.lt < 43200
             then w.ct else r.capture_time end,
        case when r.capture_time > w.ct and w.lt <> 0 and r.capture_time - w.ct + w.lt < 43200
             then w.lt else r.capture_time - w.ct end,
        case when r.capture_time > w.ct and w.lt <> 0 and r.capture_time - w.ct + w.lt < 43200
             then -1 else r.capture_time - w.ct end
    from walk w join ranked r on r.entity = w.entity and r.rn = w.rn + 1),
deltas as (select ev.id, ev.entity, ev.capture_time, coalesce(walk.last_captured, -1) as last_captured
    from ev left join walk on ev.id = walk.id)
"""
FOLD = st.with_(FOLD_SQL, recursive=True)
FOLD_V1 = FOLD.replace("43200", "720")


def sighting_rows(spark, sf):
    return st.passes(spark, sf).select("id", "entity", "capture_time")


@query("last_seen_fold", FOLD + "select * from deltas")
def last_seen_fold(spark, sf):
    return lastseen.last_seen(sighting_rows(spark, sf)).select("id", "entity", "capture_time", "last_captured")


@query("last_seen_fold_v1", FOLD_V1 + "select * from deltas")
def last_seen_fold_v1(spark, sf):
    """With the threshold of the first feed."""
    rows = lastseen.last_seen(sighting_rows(spark, sf), threshold=schemas.SUPPRESS_SECONDS_V1)
    return rows.select("id", "entity", "capture_time", "last_captured")


@query("last_seen_lag", EV + """
select id, entity, capture_time, coalesce(capture_time
    - lag(capture_time) over (partition by entity order by capture_time, id), 1) as last_captured from ev""")
def last_seen_lag(spark, sf):
    return lastseen.last_seen_simple(sighting_rows(spark, sf)).select("id", "entity", "capture_time", "last_captured")


@query("last_seen_table", FOLD + """
select reverse(entity) as rowkey, unnest(['id', 'ct', 'lt']) as qualifier, capture_time as version,
    unnest([cast(id as varchar), cast(capture_time as varchar), cast(last_captured as varchar)]) as value
from (select * from deltas where last_captured >= 0
    qualify row_number() over (partition by entity order by capture_time desc, id desc) = 1)""")
def last_seen_table(spark, sf):
    deltas = lastseen.last_seen(sighting_rows(spark, sf))
    return lastseen.state_cells(lastseen.state_table(deltas))


# Orders in the order of their keys are arrivals whose dates are far from sorted.
ARRIVALS_SQL = """
seen as (select o_orderkey as id, o_custkey as entity,
    cast(epoch(date_trunc('second', o_orderdate)) as bigint) as capture_time from orders),
arrived as (select *, capture_time - max(capture_time) over (partition by entity order by id
    rows between unbounded preceding and 1 preceding) as delta from seen)
"""
LATE_DAYS = 30 * 86_400


def _arrivals(spark, sf):
    rows = st.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity"),
        timecodes.naive_seconds(F.col("o_orderdate")).alias("capture_time"),
    )
    return asof.arrival_delta(rows, "entity", "id", "capture_time")


@query("late_classify", st.with_(ARRIVALS_SQL) + f"""
select *, case when delta is null then 'first' when delta >= 0 then 'on_time'
    when delta > -{LATE_DAYS} then 'late' else 'history' end as lateness from arrived""")
def late_classify(spark, sf):
    return _arrivals(spark, sf).withColumn("lateness", asof.late_class(F.col("delta"), LATE_DAYS))


@query("late_neighbours", st.with_(ARRIVALS_SQL) + f""",
named as (select id, 'E' || lpad(cast(entity as varchar), 7, '0') as entity, capture_time,
    case when delta > -{LATE_DAYS} then delta else -1 end as delta from arrived),
nxt as (select e.id, min(n.capture_time) as next_time
    from named e join named n on n.entity = e.entity and n.capture_time > e.capture_time
    where e.delta < 0 and e.id in (select id from arrived where delta > -{LATE_DAYS}) group by 1)
select e.id, e.entity, e.capture_time, e.delta, n.id as next_id, x.next_time
from named e left join nxt x on x.id = e.id
left join (select entity, capture_time, min(id) as id from named group by 1, 2) n
    on n.entity = e.entity and n.capture_time = x.next_time""")
def late_neighbours(spark, sf):
    rows = _arrivals(spark, sf).withColumn("entity", F.concat(F.lit("E"), F.lpad(F.col("entity").cast("string"), 7, "0")))
    found = asof.late_neighbours(rows, rows, delta="delta", limit=LATE_DAYS)
    return found.select("id", "entity", "capture_time", "delta", "next_id", "next_time")


@query("route_by_delta", st.with_(ARRIVALS_SQL) + """
select *, case when delta > 0 then 'advance' when delta = 0 then 'state' when delta < -60 then 'history'
    else 'keep' end as route from arrived""")
def route_by_delta(spark, sf):
    return _arrivals(spark, sf).withColumn("route", filters.route(F.col("delta")))


@query("asof_forward", EV + """,
nxt as (select e.id, min(n.capture_time) as next_time
    from ev e join ev n on n.entity = e.entity and n.capture_time > e.capture_time group by 1)
select e.id, e.entity, e.capture_time, n.id as next_id, x.next_time
from ev e left join (select * from nxt) x on x.id = e.id and x.next_time - e.capture_time <= 21600
left join (select entity, capture_time, min(id) as id from ev group by 1, 2) n
    on n.entity = e.entity and n.capture_time = x.next_time""")
def asof_forward(spark, sf):
    rows = sighting_rows(spark, sf)
    return asof.next_sighting(rows, rows, within=6 * 3600)
