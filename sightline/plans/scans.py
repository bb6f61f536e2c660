"""Batch scans, views, searches and day ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import session
from sightline.functions import timecodes
from sightline.operators import aggregates, documents
from sightline.plans import standins as st
from sightline.plans.registry import query
from sightline.sources import batch
from sightline.sinks import tables

EV = st.with_(st.PASSES_SQL)
DAY_SQL = "cast(strftime(ts, '%Y%m%d') as integer)"


def day_rows(spark, sf):
    """Sightings with their day, as the day-partitioned warehouse keeps them."""
    rows = st.passes(spark, sf).select("id", "entity", "capture_time", "year_id", "location_id")
    return rows.withColumn("dateid", timecodes.day_of(F.col("capture_time")))


DAY_ROWS_SQL = f"select id, entity, capture_time, year_id, location_id, {DAY_SQL} as dateid from ev"


def stored_days(spark, sf, label: str) -> str:
    path = session.scratch_path(spark, label)
    tables.append(day_rows(spark, sf), path, ["dateid"])
    return path


@query("scan_merge_schema", EV + """
select id, entity, case when category in ('click', 'error') then speed end as speed from ev""")
def scan_merge_schema(spark, sf):
    rows = st.passes(spark, sf)
    fast = F.col("category").isin("click", "error")
    path = session.scratch_path(spark, "merge-schema")
    rows.filter(fast).select("id", "entity", "speed").write.parquet(f"{path}/gen=1")
    rows.filter(~fast).select("id", "entity").write.parquet(f"{path}/gen=2")
    return batch.parquet(spark, path, merge_schema=True).select("id", "entity", "speed")


@query("scan_partition", EV + f"select * from ({DAY_ROWS_SQL}) where dateid = 20240115")
def scan_partition(spark, sf):
    return batch.day(batch.parquet(spark, stored_days(spark, sf, "scan")), 20240115)


@query("scan_json", EV + "select id, entity, capture_time, feature from ev")
def scan_json(spark, sf):
    path = session.scratch_path(spark, "json")
    st.passes(spark, sf).select("id", "entity", "capture_time", "feature").write.json(path)
    return batch.json_lines(spark, path, "id bigint, entity string, capture_time bigint, feature string")


@query("temp_view_sql", EV + "select category, count(*) as n_rows, max(speed) as top_speed from ev group by 1")
def temp_view_sql(spark, sf):
    st.passes(spark, sf).createOrReplaceTempView("sightings_view")
    return spark.sql(
        "select category, count(*) as n_rows, max(speed) as top_speed from sightings_view group by category"
    )


LANG = "en"


@query("search_term_range", f"""
select doc_id, lang, n_chars, source from documents where lang = '{LANG}' and n_chars between 500 and 2000
order by n_chars, doc_id limit 10""")
def search_term_range(spark, sf):
    docs = st.table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "source")
    return documents.search(
        docs, F.col("lang") == LANG, F.col("n_chars").between(500, 2000), ["n_chars", "doc_id"], 10
    )


@query("search_total_hits", f"""
select count(*) as total_hits, count(*) filter (n_chars between 500 and 2000) as filtered_hits
from documents where lang = '{LANG}'""")
def search_total_hits(spark, sf):
    docs = st.table(spark, sf, "documents")
    return documents.hit_counts(docs, F.col("lang") == LANG, F.col("n_chars").between(500, 2000))


@query("incremental_union", EV + f"""
select dateid, count(*) as n_rows, count(distinct entity) as n_entities
from ({DAY_ROWS_SQL}) where dateid between 20240110 and 20240119 group by 1""")
def incremental_union(spark, sf):
    """Ten days read as one pruned scan of a table that days are appended to."""
    path = session.scratch_path(spark, "grow")
    rows = day_rows(spark, sf)
    early = F.col("dateid") <= 20240115
    tables.append(rows.filter(early), path, ["dateid"])
    tables.append(rows.filter(~early), path, ["dateid"])
    window = batch.days_between(batch.parquet(spark, path), 20240110, 20240119)
    counts = window.groupBy("dateid").agg(F.count("*").alias("n_rows"))
    return counts.join(aggregates.distinct_per_day(window, "dateid", "entity"), "dateid")


@query("batch_metrics", EV + """
select count(*) as n_rows, count(*) filter (part_type > 0) as n_parts,
    count(*) filter (feature is null) as n_without_feature from ev""")
def batch_metrics(spark, sf):
    """Counts taken while the batch is written, not by further passes over it."""
    rows, metrics = aggregates.observed(
        st.passes(spark, sf), "pass_batch", n_parts=F.col("part_type") > 0, n_without_feature=F.col("feature").isNull()
    )
    rows.write.parquet(session.scratch_path(spark, "metrics"))
    return spark.createDataFrame([metrics.get], "n_rows bigint, n_parts bigint, n_without_feature bigint")
