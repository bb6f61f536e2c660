"""Partitioned Parquet tables.

Before a partitioned write the rows are rebalanced on the partition columns: each partition is
gathered into few files, and adaptive execution splits one that is too large for a task, so a day
that holds a third of all rows is written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.sources import folders
from sightline.streaming.run import Batch


def append(
    df: DataFrame,
    path: str,
    by: list[str],
    spread_on: list[str] | None = None,
    compression: str | None = None,
    max_records: int | None = None,
) -> None:
    """Append to a folder table; ``spread_on`` replaces ``by`` as the gathering columns."""
    writer = df.hint("rebalance", *(spread_on or by)).write.mode("append").partitionBy(*by)
    if compression:
        writer = writer.option("compression", compression)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_batch(
    df: DataFrame, batch: Batch, path: str, by: list[str] | None = None, fmt: str = "parquet",
    unique: list[str] | None = None,
) -> None:
    """Write a micro-batch into a folder of its own, ``run_id=…/batch_id=…``.

    A batch that has been written is left alone, so a replay adds nothing and a reader's files stay;
    one whose write was cut off is written anew. Other runs' rows are never touched. A new run over
    rows that an earlier one has written, whatever its batches were, adds only those whose
    ``unique`` columns no other run has; without ``unique`` it adds all of them.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    target = f"{path}/run_id={batch.run}/batch_id={batch.number}"
    if folders.exists(spark, f"{target}/_SUCCESS"):
        return
    others = [n for n in folders.names(spark, path) if n.startswith("run_id=") and n != f"run_id={batch.run}"]
    if unique and others:
        stored = spark.read.format(fmt).schema(df.schema).option("basePath", path).load([f"{path}/{n}" for n in others])
        df = df.join(stored.select(*unique).distinct(), unique, "left_anti").select(*df.columns)
    rows = df.hint("rebalance", *by) if by else df
    writer = rows.write.mode("overwrite").format(fmt)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(target)


def merge_batches(spark: SparkSession, path: str, runs: list[str], into: str, by: list[str] | None = None) -> None:
    """Rewrite finished runs' small batch folders as one folder, ``run_id={into}/batch_id=0``.

    The runs must have ended. Their folders are removed after the merged one is complete; if that is
    cut off, merging again first finds the merged folder and only removes.
    """
    path = path.rstrip("/")
    sources = [f"{path}/run_id={r}" for r in runs if folders.exists(spark, f"{path}/run_id={r}")]
    if sources and not folders.exists(spark, f"{path}/run_id={into}/batch_id=0/_SUCCESS"):
        rows = spark.read.option("basePath", path).parquet(*sources).drop("run_id", "batch_id")
        write_batch(rows, Batch(into, 0), path, by)
    for source in sources:
        folders.remove(spark, source)


def create(spark: SparkSession, name: str, like: DataFrame, path: str, by: list[str]) -> str:
    """A catalog table over ``path`` with the columns of ``like``, partitioned by ``by``."""
    plain = [f for f in like.schema.fields if f.name not in by]
    parts = [like.schema[c] for c in by]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain + parts)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"create table if not exists {name} ({columns}) using parquet "
        f"partitioned by ({keys}) location '{path}'"
    )
    return name


def insert(spark: SparkSession, name: str, df: DataFrame, spread_on: list[str]) -> None:
    """``INSERT INTO`` with dynamic partitions, gathered by ``spread_on``; columns go by name."""
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns)
    hint = ", ".join(f"`{c}`" for c in spread_on)
    spark.sql(
        f"insert into {name} ({columns}) select /*+ REBALANCE({hint}) */ {columns} from {{rows}}", rows=df
    )


def replace_partitions(df: DataFrame, name: str) -> None:
    """Overwrite exactly the partitions that ``df`` has rows for.

    The mode is a session setting for catalog tables (a writer option is not looked at), so it
    is set around the write.
    """
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)


def replace_partition(df: DataFrame, name: str, column: str, value: int) -> None:
    """Overwrite one static partition with all its sub-partitions, and nothing else."""
    spark = df.sparkSession
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    spec = ", ".join(f"`{k}` = {int(value)}" if k == column else f"`{k}`" for k in keys)
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != column)
    spark.sql(f"insert overwrite table {name} partition ({spec}) select {columns} from {{rows}}", rows=df)


def files_per_partition(table: DataFrame, by: list[str]) -> DataFrame:
    named = table.select(*by, F.input_file_name().alias("_file"))
    return named.groupBy(*by).agg(F.count_distinct("_file").alias("n_files"))
