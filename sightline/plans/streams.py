"""Streaming queries; each runs until its input is used up and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import schemas, session
from sightline.functions import timecodes
from sightline.operators import decode, enrich, filters, project
from sightline.operators.documents import to_documents
from sightline.plans import standins as st
from sightline.plans.registry import query
from sightline.plans.scans import EV
from sightline.plans.timeline import FOLD, FOLD_SQL, sighting_rows
from sightline.sinks import indexes, messages, tables
from sightline.sources import folders, stream
from sightline.streaming import lastseen, run


def _table_stream(spark, sf, name):
    static = st.table(spark, sf, name)
    return stream.files(spark, sf, static.schema, glob=f"{name}.parquet")


def _written(spark, df, label):
    """A folder holding ``df`` as the files of a feed, with the schema to read them."""
    path = session.scratch_path(spark, label)
    df.write.parquet(path)
    return path, df.schema


def by_time(spark, df, seconds, path, parts=5, fmt="parquet"):
    """Write a feed as a folder for each of consecutive time ranges; the folders' names, oldest first.

    Rows of one second stay together, rows without a time come first. One job writes all of them, each
    task its rows of every range.
    """
    at = [i / parts for i in range(1, parts)]
    cuts = sorted({c for c in df.agg(F.percentile_approx(seconds, at).alias("c")).first().c or []})
    place = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(seconds))), F.lit(0)) if cuts else F.lit(0)
    rows = df.withColumn("_range", F.when(F.col(seconds).isNull(), 0).otherwise(place))
    (rows.drop(seconds) if fmt == "text" else rows).write.partitionBy("_range").format(fmt).save(path)
    return sorted(n for n in folders.names(spark, path) if n.startswith("_range="))


def in_turn(spark, query, staged, names, feed):
    """Move staged folders into a running query's feed, each when the ones before have been handled; then stop."""
    try:
        for name in names:
            folders.move(spark, f"{staged}/{name}", f"{feed}/{name.removeprefix('_')}")
            query.processAllAvailable()
    finally:
        query.stop()


@query("stream_scan", "select event_id, ts, user_id, event_type, value, props from events")
def stream_scan(spark, sf):
    root = session.scratch_path(spark, "stream-scan")
    source = _table_stream(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    run.drain(run.to_files(source, f"{root}/out", f"{root}/ckpt"))
    return spark.read.schema(source.schema).parquet(f"{root}/out")


@query("stream_union", """
select c_name as name, c_nationkey as nation, c_acctbal as balance from customer
union all select s_name, s_nationkey, s_acctbal from supplier""")
def stream_union(spark, sf):
    root = session.scratch_path(spark, "stream-union")
    parts = [
        _table_stream(spark, sf, name).select(
            F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation"), F.col(f"{p}_acctbal").alias("balance")
        )
        for name, p in (("customer", "c"), ("supplier", "s"))
    ]
    run.drain(run.to_files(stream.union(parts), f"{root}/out", f"{root}/ckpt"))
    return spark.read.parquet(f"{root}/out")


@query("last_seen_stream", FOLD + "select * from deltas")
def last_seen_stream(spark, sf):
    root = session.scratch_path(spark, "last-seen")
    return _last_seen_over(spark, root, {"c": sighting_rows(spark, sf)})


SIGHTINGS = "id bigint, entity string, capture_time bigint"


def _last_seen_over(spark, root, feeds, parts=5):
    """Feeds (checkpoint: rows), a time range a batch, into one sink over one state table."""
    for checkpoint, rows in feeds.items():
        names = by_time(spark, rows.select("id", "entity", "capture_time"), "capture_time", f"{root}/staged-{checkpoint}", parts)
        writers = {"deltas": lambda df, b: tables.write_batch(df, b, f"{root}/out", unique=["id"])}
        handle = lastseen.last_seen_batches(lastseen.StateTable(f"{root}/state", fan=3, buckets=BUCKETS), writers)
        feed = f"{root}/feed-{checkpoint}"
        folders.make(spark, feed)
        query = run.by_batch(stream.files(spark, feed, SIGHTINGS, recursive=True), handle, f"{root}/{checkpoint}", every=AT_ONCE)
        in_turn(spark, query, f"{root}/staged-{checkpoint}", names, feed)
    return spark.read.parquet(f"{root}/out").select("id", "entity", "capture_time", "last_captured")


@query("replay_fresh_checkpoint", FOLD + "select * from deltas")
def replay_fresh_checkpoint(spark, sf):
    """The feed in two halves under two checkpoints: the state goes on and the sink keeps both."""
    root = session.scratch_path(spark, "fresh-checkpoint")
    rows = sighting_rows(spark, sf)
    middle = rows.agg(F.percentile_approx("capture_time", 0.5).alias("m")).first().m
    halves = {"old": rows.filter(F.col("capture_time") <= middle), "new": rows.filter(F.col("capture_time") > middle)}
    return _last_seen_over(spark, root, halves, 3)


def _in_state_store(spark, root, rows, **options):
    """Five time ranges, a batch each, through the state store."""
    names = by_time(spark, rows, "capture_time", f"{root}/staged")
    folders.make(spark, f"{root}/in")
    source = stream.files(spark, f"{root}/in", SIGHTINGS, recursive=True)
    query = run.to_files(lastseen.last_seen_stream(source, **options), f"{root}/out", f"{root}/ckpt", every=AT_ONCE)
    in_turn(spark, query, f"{root}/staged", names, f"{root}/in")
    return spark.read.parquet(f"{root}/out").select("id", "entity", "capture_time", "last_captured")


@query("last_seen_state_store", FOLD + "select * from deltas")
def last_seen_state_store(spark, sf):
    """The same with the state in Spark's state store."""
    return _in_state_store(spark, session.scratch_path(spark, "state-store"), sighting_rows(spark, sf))


HORIZON = 3 * 86_400


def _expiring_sql() -> str:
    """The fold in which an entity that was last counted longer ago than the horizon starts anew."""
    known = "case when r.capture_time > w.ct and"
    first, *rest = FOLD_SQL.split(known)
    fresh = [f"case when r.capture_time - w.ct > {HORIZON} then {v} when r.capture_time > w.ct and" for v in ("r.capture_time", "0", "0")]
    return st.with_(first + "".join(a + b for a, b in zip(fresh, rest)), recursive=True)


@query("last_seen_expiring", _expiring_sql() + "select * from deltas")
def last_seen_expiring(spark, sf):
    """State that is given up by event-time timers once it is older than the horizon."""
    return _in_state_store(spark, session.scratch_path(spark, "expiring"), sighting_rows(spark, sf), horizon=HORIZON)


@query("multi_sink_counts", EV + """
select 'rows' as sink, count(*) as n_rows from ev
union all select 'features', count(*) from ev where feature is not null and feature <> ''
union all select 'messages', count(*) from ev""")
def multi_sink_counts(spark, sf):
    """One batch, computed once, to a day-partitioned table, a feature table and a topic."""
    root = session.scratch_path(spark, "fan-out")
    rows = st.passes(spark, sf).withColumn("dateid", timecodes.day_of(F.col("capture_time")))
    path, schema = _written(spark, rows, "passes")
    present = filters.feature_present(F.col("feature"))
    writers = {
        "rows": lambda df, b: tables.write_batch(df, b, f"{root}/rows", ["dateid"]),
        "features": lambda df, b: tables.write_batch(df.filter(present), b, f"{root}/features"),
        "messages": lambda df, b: tables.write_batch(messages.as_json(df), b, f"{root}/messages", fmt="text"),
    }
    run.drain(run.for_each(stream.files(spark, path, schema), writers, f"{root}/ckpt"))
    counted = [
        (spark.read.text(f"{root}/{name}") if name == "messages" else spark.read.parquet(f"{root}/{name}"))
        .agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("sink"), "n_rows")
        for name in writers
    ]
    return stream.union(counted)


#: Buckets of the state tables here; their entities are few.
BUCKETS = 8
#: A batch as soon as there is something.
AT_ONCE = "0 seconds"

CLOCK = 1706745600  # what an event without a time to send gets

#: Document field -> SQL over the tables joined in TWO_STAGE_SQL; the others are missing in the feed.
_GIVEN_SQL = {
    "id": "ev.id", "yearId": "ev.year_id", "modelId": "coalesce(p_size, -1)",
    "brandId": "coalesce(cast(split_part(p_brand, '#', 2) as integer), -1)", "plateNumber": "ev.entity",
    "regionCode": "coalesce(n_nationkey + 100, 0)", "captureTime": "ev.capture_time", "nodeId": "ev.node_id",
    "partType": "ev.part_type", "plateTypeId": "coalesce(length(r_name), -1)", "plateCategoryId": "ev.part_type",
    "lastCaptured": "deltas.last_captured", "sendTime": str(CLOCK), "locationId": "ev.location_id",
}


def _body_sql() -> str:
    kinds, parts = dict(schemas.fields_of(schemas.EVENT_V2)), []
    for code, field in schemas.DOCUMENT_V2.items():
        text = kinds[field] == "string"
        value = _GIVEN_SQL.get(field, "''" if text else "-1")
        mark = '"' if text else ""
        parts.append(f"""'"{code}":{mark}' || ({value}) || '{mark}'""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


TWO_STAGE_SQL = st.with_(FOLD_SQL.replace("from ev where", "from ev where category <> 'error' and"), recursive=True) + f"""
select 'pass' || strftime(make_timestamp(ev.capture_time * 1000000), '%Y%m') as index_name,
    cast(ev.id as varchar) as doc_id, ev.capture_time as version, {_body_sql()} as body
from ev join deltas on ev.id = deltas.id left join part on p_partkey = ev.year_id
left join nation on 'N' || n_regionkey = ev.node_id and 'L' || n_nationkey = ev.location_id
left join region on r_regionkey = ev.part_type
where category <> 'error'"""


def _enriched(spark, sf, events):
    """J1 to J3 over whole format 2 events; an event's part type stands in for its category."""
    years = st.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("yearId"), F.substring_index("p_brand", "#", -1).cast("int").alias("brandId"),
        F.col("p_size").alias("modelId"),
    )
    places = st.table(spark, sf, "nation").select(
        F.concat(F.lit("N"), "n_regionkey").alias("nodeId"), F.concat(F.lit("L"), "n_nationkey").alias("locationId"),
        (F.col("n_nationkey") + 100).cast("int").alias("regionCode"),
    )
    kinds = st.table(spark, sf, "region").select(
        F.col("r_regionkey").cast("int").alias("plateCategoryId"), F.length("r_name").alias("plateTypeId")
    )
    rows = events.drop("brandId", "modelId", "regionCode", "plateTypeId").withColumn("plateCategoryId", F.col("partType"))
    rows = enrich.lookup(rows, years, ["yearId"], {"brandId": -1, "modelId": -1})
    rows = enrich.lookup(rows, places, ["nodeId", "locationId"], {"regionCode": schemas.UNKNOWN_REGION_V2})
    return enrich.lookup(rows, kinds, ["plateCategoryId"], {"plateTypeId": -1})


@query("two_stage_feed", TWO_STAGE_SQL)
def two_stage_feed(spark, sf):
    """Lines -> decode, enrich, last-seen -> JSON feed -> decode -> monthly documents.

    Two queries with their own checkpoints, running at once, joined by the feed between them: whole
    events go in, whole events are published, all document fields are indexed.
    """
    root = session.scratch_path(spark, "two-stage")
    lines = st.lines(spark, sf).withColumn("_at", F.get_json_object("value", "$.captureTime").cast("bigint"))
    # a line that is cut off has a time only its text tells
    lines = lines.withColumn("_at", F.coalesce("_at", F.regexp_extract("value", '"captureTime":([0-9]+)', 1).cast("bigint")))
    names = by_time(spark, lines, "_at", f"{root}/staged", fmt="text")
    folders.make(spark, f"{root}/lines")
    source = stream.files(spark, f"{root}/lines", "value string", fmt="text", recursive=True)
    events = decode.valid(decode.decode_json(source, schemas.EVENT_V2)).drop("value")
    fields = [name for name, _ in schemas.fields_of(schemas.EVENT_V2)]
    clock = F.timestamp_seconds(F.lit(CLOCK))

    def republish(deltas, batch):
        whole = project.default_nulls(deltas.select(*fields), now=clock)
        tables.write_batch(messages.as_json(whole), batch, f"{root}/feed", fmt="text")

    seen = lastseen.last_seen_batches(
        lastseen.StateTable(f"{root}/state", buckets=BUCKETS), {"feed": republish}, "plateNumber", "captureTime", "id", result="lastCaptured"
    )

    def index(rows, batch):
        coded = project.coded(rows, schemas.DOCUMENT_V2)
        name = F.concat(F.lit("pass"), timecodes.month_tag(F.col("A009")))
        indexes.write_monthly(to_documents(coded, "A001", name, F.col("A009"), coded.columns), batch, f"{root}/docs")

    folders.make(spark, f"{root}/feed")
    first = run.by_batch(_enriched(spark, sf, events.drop("lastCaptured")), seen, f"{root}/c1", every=AT_ONCE)
    feed = stream.files(spark, f"{root}/feed", "value string", fmt="text", recursive=True)
    again = decode.valid(decode.decode_json(feed, schemas.EVENT_V2))
    second = run.for_each(again, {"documents": index}, f"{root}/c2", every=AT_ONCE)
    try:
        in_turn(spark, first, f"{root}/staged", names, f"{root}/lines")
        second.processAllAvailable()
    finally:
        second.stop()
    return indexes.read(spark, f"{root}/docs")
