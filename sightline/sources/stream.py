"""Streaming scans. Positions live in the query's checkpoint.

A restarted query goes on where its checkpoint stands; only the first run looks at the start
position. Readers can be given an admission limit, so that a backlog comes in several batches; without
one a batch is all there is.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def files(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files: int | None = None,
    max_bytes: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Files of a folder as they arrive, oldest first; at most ``max_files`` or ``max_bytes`` per batch if given.

    ``recursive`` takes the files of all folders below and none of their names as columns."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def topic(
    spark: SparkSession,
    servers: str,
    name: str,
    start: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """A Kafka topic as a column ``value STRING`` (needs the connector on the class path).

    ``start`` is ``earliest`` or ``latest`` and counts for the first run. A stored position
    older than the topic's retention goes on at the earliest one kept instead of failing.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("startingOffsets", start)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().selectExpr("cast(value as string) as value")


def union(streams: Iterable[DataFrame]) -> DataFrame:
    """Several receivers of the same feed as one stream."""
    return reduce(lambda a, b: a.unionByName(b), streams)
