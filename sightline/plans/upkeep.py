"""Partition maintenance on tables made from the driver's events."""

from __future__ import annotations

from pyspark.sql import functions as F

from sightline import session
from sightline.maintenance import days
from sightline.plans import standins as st
from sightline.plans.registry import query
from sightline.plans.scans import DAY_ROWS_SQL, EV, day_rows
from sightline.sinks import tables

LAST_DAY = 20240130


def _table(spark, sf, label, by=("dateid",), fill=True):
    rows = day_rows(spark, sf)
    path = session.scratch_path(spark, label)
    name = tables.create(spark, f"{label}_" + path.rsplit("-", 1)[1], rows, path, list(by))
    if fill:
        tables.insert(spark, name, rows, list(by))
    return name


def _rows(spark, name):
    return spark.table(name).select("id", "entity", "capture_time", "year_id", "location_id", "dateid")


@query("partition_probe", """
with d as (select distinct cast(strftime(l_shipdate, '%Y%m%d') as integer) as dateid from lineitem),
o as (select distinct cast(strftime(o_orderdate, '%Y%m%d') as integer) as dateid from orders)
select d.dateid, case when o.dateid is null then 0 else 1 end as present from d left join o on d.dateid = o.dateid""")
def partition_probe(spark, sf):
    def day(name, column):
        return st.table(spark, sf, name).select(F.date_format(column, "yyyyMMdd").cast("int").alias("dateid"))

    found = days.probe(day("lineitem", "l_shipdate"), day("orders", "o_orderdate"))
    return found.select("dateid", F.col("present").cast("int").alias("present"))


@query("compact_day", EV + f"select *, true as fewer_files from ({DAY_ROWS_SQL})")
def compact_day(spark, sf):
    """The day is filled by three inserts first; the result says whether it has fewer files than before."""
    rows = day_rows(spark, sf)
    name = _table(spark, sf, "compact", fill=False)
    for i in range(3):
        tables.insert(spark, name, rows.filter(F.pmod(F.hash("id"), F.lit(3)) == i), ["dateid"])
    before = len(days.files_of(spark, name, LAST_DAY))
    days.compact_day(spark, name, LAST_DAY, "year_id")
    fewer = 0 < len(days.files_of(spark, name, LAST_DAY)) < before or before <= 1
    return _rows(spark, name).withColumn("fewer_files", F.lit(fewer))


@query("compact_range", EV + f"""
select *, 1 as n_files from ({DAY_ROWS_SQL})""")
def compact_range(spark, sf):
    """Days filled by three inserts, compacted by one job; the result tells each day's files afterwards."""
    rows = day_rows(spark, sf)
    name = _table(spark, sf, "ranged", fill=False)
    for i in range(3):
        tables.insert(spark, name, rows.filter(F.pmod(F.hash("id"), F.lit(3)) == i), ["dateid"])
    days.compact_range(spark, name, 0, 99991231, "year_id")
    files = days.layout(spark, name, 0, 99991231).groupBy(F.col("dateid").alias("_day")).agg(F.count("*").cast("int").alias("n_files"))
    return _rows(spark, name).join(files, F.col("dateid") == F.col("_day")).drop("_day")


@query("drop_partition", EV + f"select * from ({DAY_ROWS_SQL}) where dateid <> {LAST_DAY}")
def drop_partition(spark, sf):
    name = _table(spark, sf, "dropped")
    days.drop_day(spark, name, LAST_DAY)
    return _rows(spark, name)


@query("move_day", EV + f"""
select id, entity, capture_time, year_id, location_id, {LAST_DAY} as dateid from ev""")
def move_day(spark, sf):
    """A folder of Parquet files into one static day partition."""
    path = session.scratch_path(spark, "incoming")
    day_rows(spark, sf).drop("dateid").write.parquet(path)
    name = _table(spark, sf, "moved", fill=False)
    days.import_day(spark, path, name, LAST_DAY, by="location_id")
    return _rows(spark, name)


@query("merge_days", EV + f"""
select *, 1 as merged from ({DAY_ROWS_SQL}) where dateid between 20240121 and {LAST_DAY}
union all select *, 0 from ({DAY_ROWS_SQL}) where dateid < 20240121""")
def merge_days(spark, sf):
    """The last ten days go to (dateid, location_id) partitions; the source keeps the others."""
    source = _table(spark, sf, "daily")
    target = _table(spark, sf, "merged", by=("dateid", "location_id"), fill=False)
    days.merge_days(spark, source, target, LAST_DAY, days.days_back(LAST_DAY, 9), ["dateid", "location_id"])
    return _rows(spark, target).withColumn("merged", F.lit(1)).unionByName(
        _rows(spark, source).withColumn("merged", F.lit(0))
    )
