"""Document indexes as tables of versions, partitioned by index.

Batches are added beside what is stored; ``compact`` folds them in, and rewrites only the buckets of
an index that got something. Every change is one new version (``snapshots``): a load, patch or
compaction that is cut off leaves the version before it, whole, and a reader stays on the version
it began with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline import schemas
from sightline.operators import documents
from sightline.sinks.snapshots import Manifest, Snapshots
from sightline.streaming.run import Batch

#: Buckets that the documents of an index are dealt out to.
BUCKETS = 16
STORED = "doc_id string, version bigint, seq bigint, body string, index_name string"
COLUMNS = ["index_name", "doc_id", "version", "body"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")


def _parts(state: Manifest, buckets: int) -> dict:
    """``base``: "index_name=…/bucket=…" -> folder; ``fresh``: folders of batches, oldest first."""
    found = state.parts or {"base": {}, "fresh": [], "buckets": buckets}
    return {**found, "base": dict(found["base"]), "fresh": list(found["fresh"])}


def _key(spark: SparkSession, index: str | None, bucket: int | None = None) -> str:
    """The folder name of an index, or of one of its buckets, as a partitioned write makes it."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = utils.getPartitionPathString("index_name", index)
    return name if bucket is None else f"{name}/bucket={bucket}"


def _load(spark: SparkSession, path: str, base: list[str], fresh: list[str]) -> DataFrame:
    rows = spark.createDataFrame([], STORED).select(*COLUMNS, "seq")
    for runs in (base, fresh):  # their folders have different partition columns
        if runs:
            reader = spark.read.schema(STORED).option("basePath", f"{path}/data")
            rows = rows.union(reader.parquet(*[f"{path}/{run}" for run in runs]).select(*COLUMNS, "seq"))
    return rows


def _upsert(rows: DataFrame) -> DataFrame:
    """One document per id: the newest version, of that the last patch, else the greater body."""
    newest = rows.groupBy("index_name", "doc_id").agg(F.max(F.struct("version", "seq", "body")).alias("_d"))
    return newest.select("index_name", "doc_id", "_d.version", "_d.body", "_d.seq")


def _write(rows: DataFrame, path: str, run: str, by: list[str]) -> None:
    """Rows as files of at most one bulk request's documents."""
    rows.hint("rebalance", *by).write.mode("overwrite").option(
        "maxRecordsPerFile", schemas.DOCUMENTS_PER_FILE
    ).partitionBy(*by).parquet(f"{path}/{run}")


def _add(rows: DataFrame, state: Manifest, parts: dict, batch: Batch, path: str) -> None:
    run = f"data/run={state.version + 1}"
    _write(rows, path, run, ["index_name"])
    parts["fresh"].append(run)
    Snapshots(path).commit(rows.sparkSession, state, parts, batch)


def write_monthly(docs: DataFrame, batch: Batch, path: str, buckets: int = BUCKETS) -> None:
    """Add a batch's documents, one per id; a batch that is in the index already is left alone."""
    state = Snapshots(path).newest(docs.sparkSession)
    if not state.holds(batch):
        rows = documents.upsert(docs).withColumn("seq", F.lit(0).cast("bigint"))
        _add(rows, state, _parts(state, buckets), batch, path.rstrip("/"))


def patch_monthly(patches: DataFrame, body: T.StructType, batch: Batch, path: str) -> None:
    """Change fields of stored documents: (index_name, doc_id, version, *fields), NULL for no change.

    ``body`` is the schema of the documents, whose other fields stay. Of several patches the newest
    value of each field counts, the greater one on a tie. A document gets its newest patch's version
    if that is newer than its own; one that the index does not have is not made. Only the buckets of
    the patched documents and the batches since the last compaction are read.
    """
    spark, path = patches.sparkSession, path.rstrip("/")
    state = Snapshots(path).newest(spark)
    if state.holds(batch):
        return
    parts = _parts(state, BUCKETS)
    fields = [c for c in patches.columns if c not in ("index_name", "doc_id", "version")]

    def newest(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct("version", F.col(c).alias("v")))).getField("v").alias(f"_p_{c}")

    side = patches.groupBy("index_name", "doc_id").agg(F.max("version").alias("_version"), *map(newest, fields))
    touched = side.select("index_name", _bucket(parts["buckets"]).alias("bucket")).distinct().collect()
    keys = [_key(spark, r.index_name, r.bucket) for r in touched]
    stored = _upsert(_load(spark, path, [parts["base"][k] for k in keys if k in parts["base"]], parts["fresh"]))
    joined = stored.join(side, ["index_name", "doc_id"]).withColumn("_body", F.from_json("body", body))

    def changed(name: str) -> Column:
        old = F.col("_body").getField(name)
        return (F.coalesce(f"_p_{name}", old) if name in fields else old).alias(name)

    rows = joined.select(
        "index_name", "doc_id", F.greatest("version", "_version").alias("version"),
        F.to_json(F.struct(*[changed(f.name) for f in body])).alias("body"),
        F.lit(state.version + 1).cast("bigint").alias("seq"),
    )
    _add(rows, state, parts, batch, path)


def compact(spark: SparkSession, path: str) -> None:
    """Fold the batches since the last compaction into the index: one document per id.

    Of the index only the buckets that get something are read and written again.
    """
    path, table = path.rstrip("/"), Snapshots(path)
    state = table.newest(spark)
    parts = _parts(state, BUCKETS)
    if not parts["fresh"]:
        return
    fresh = _load(spark, path, [], parts["fresh"]).withColumn("bucket", _bucket(parts["buckets"]))
    keys = {_key(spark, r.index_name, r.bucket) for r in fresh.select("index_name", "bucket").distinct().collect()}
    replaced = [parts["base"][k] for k in keys if k in parts["base"]]
    rows = _upsert(_load(spark, path, replaced, parts["fresh"])).withColumn("bucket", _bucket(parts["buckets"]))
    run = f"data/run={state.version + 1}"
    _write(rows, path, run, ["index_name", "bucket"])
    gone, parts["fresh"] = [*parts["fresh"], *replaced], []
    parts["base"] |= {k: f"{run}/{k}" for k in keys}
    table.commit(spark, state, parts, gone=gone)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The index as a reader sees it: one document per id, in its newest or the given version."""
    path, table = path.rstrip("/"), Snapshots(path)
    state = table.newest(spark) if version is None else table.at(spark, version)
    parts = _parts(state, BUCKETS)
    rows = _load(spark, path, list(parts["base"].values()), parts["fresh"])
    return (_upsert(rows) if parts["fresh"] else rows).select(*COLUMNS)
