"""Starting queries.

Progress is committed after a batch's writes, so a batch may run twice. Every sink here is
either Spark's own file sink, which notices, or leaves alone what the same batch has written.
A batch is known by its run, the id that the checkpoint gave the query, and its number there: a
restarted query goes on under its id, a new checkpoint is another run and numbers from 0.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


class Batch(NamedTuple):
    run: str
    number: int


Writer = Callable[[DataFrame, Batch], None]


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint gave its query; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def _trigger(writer, every: str | None):
    """A processing-time interval, or everything there is now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
    by: list[str] | None = None, every: str | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if by:
        writer = writer.partitionBy(*by)
    return _trigger(writer, every).start(path)


def to_topic(
    stream: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    writer = (
        stream.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, every).start()


def for_each(
    stream: DataFrame, writers: dict[str, Writer], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hand every batch to several writers, computing it once."""
    return by_batch(stream, fan_out(writers), checkpoint, every)


def by_batch(stream: DataFrame, handle: Writer, checkpoint: str, every: str | None = None) -> StreamingQuery:
    known: list[str] = []

    def named(batch: DataFrame, number: int) -> None:
        if not known:
            known.append(run_id(batch.sparkSession, checkpoint))
        handle(batch, Batch(known[0], number))

    return _trigger(
        stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint), every
    ).start()


def fan_out(writers: dict[str, Writer]) -> Writer:
    """One batch, persisted once, given to each writer; an empty batch writes nothing."""
    def handle(rows: DataFrame, batch: Batch) -> None:
        rows = rows.persist()
        try:
            if not rows.isEmpty():
                for write in writers.values():
                    write(rows, batch)
        finally:
            rows.unpersist()
    return handle


def drain(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself, and pass on its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
