"""Last-seen over a stream: by a state table per batch, or in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from sightline import schemas
from sightline.operators import lastseen
from sightline.operators.lastseen import SUPPRESSED, step, tracked_key
from sightline.streaming.run import Batch, Writer
from sightline.streaming.statetable import StateTable


def _by_time(row: tuple) -> tuple:
    """Sorts (second, whether the id is unknown, id, place) with unknown ids last."""
    t, unknown, i, _ = row
    return (t, unknown, 0) if unknown else (t, unknown, i)


def _update(threshold: int, seconds: str, row_id: str, result: str, columns: list[str], horizon: int | None):
    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if key[0] is None or pd.isna(key[0]):
            for rows in chunks:
                yield rows.assign(**{result: SUPPRESSED})[columns]
            return
        # numbers, not tables: most groups are a few rows, and there is a group for each entity and batch
        held = list(chunks)
        rows = held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
        times, ids = rows[seconds].tolist(), rows[row_id].tolist()
        order = sorted(zip(times, map(pd.isna, ids), ids, range(len(ids))), key=_by_time)
        seen = state.exists
        ct, lt = state.get if seen else (0, 0)
        out, last = [0] * len(ids), None
        for t, unknown, i, at in order:
            one = (t, unknown, None if unknown else i)
            if one != last:  # repeated rows have one result
                delta, ct, lt = step(seen, ct, lt, t, threshold, horizon)
                seen, last = True, one
            out[at] = delta
        state.update((int(ct), int(lt)))
        if horizon is not None:
            # the rule needs no timer; it is what frees the state of entities that do not come back
            state.setTimeoutTimestamp(max((int(ct) + horizon) * 1000, state.getCurrentWatermarkMs()) + 1)
        yield rows.assign(**{result: out})[columns]
    return run


def last_seen_stream(
    rows: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    threshold: int = schemas.SUPPRESS_SECONDS_V2,
    valid: Column | None = None,
    result: str = "last_captured",
    horizon: int | None = None,
    lateness: str = "1 hour",
) -> DataFrame:
    """Add the last-seen delta to a stream; same rules as ``operators.lastseen.last_seen``.

    Within a batch an entity's rows are taken by (time, id); a row that is older than the state
    gives a negative delta and leaves it alone. An entity's rows of one batch are handled
    together, so the batch size is what bounds them: this form is for small, frequent batches
    behind an admission limit. ``last_seen_batches`` has no such bound.

    With ``horizon`` (seconds, at least the threshold) an entity that was last counted longer ago
    starts anew, and an event-time timer removes its state when the stream has passed that time, so
    the state store holds the entities of one horizon. Tracked rows that are more than ``lateness``
    behind the newest one of the batches before are then dropped, as Spark does behind a watermark.
    """
    key = tracked_key(rows, entity, seconds, valid)
    output = T.StructType(list(rows.schema.fields) + [T.StructField(result, T.LongType())])
    update = _update(threshold, seconds, row_id, result, output.names, horizon)
    if horizon is not None:
        timed = rows.withColumns({"_entity": key, "_spread": F.lit(0), "_at": F.timestamp_seconds(seconds)})
        tracked = timed.filter("_entity is not null").withWatermark("_at", lateness)
        deltas = tracked.groupBy("_entity", "_spread").applyInPandasWithState(
            update, output, "ct bigint, lt bigint", "append", "EventTimeTimeout"
        )
        return deltas.union(rows.filter(key.isNull()).withColumn(result, F.lit(SUPPRESSED).cast("bigint")))
    # untracked rows have no state: they make as many groups as there are shuffle partitions
    groups = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.when(key.isNull(), F.pmod(F.xxhash64(row_id), F.lit(groups))).otherwise(F.lit(0))
    keyed = rows.withColumns({"_entity": key, "_spread": spread.cast("int")})
    return keyed.groupBy("_entity", "_spread").applyInPandasWithState(
        update, output, "ct bigint, lt bigint", "append", "NoTimeout"
    )


def last_seen_batches(
    state: StateTable,
    writers: dict[str, Writer],
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    threshold: int = schemas.SUPPRESS_SECONDS_V2,
    result: str = "last_captured",
) -> Writer:
    """A ``foreachBatch`` handler: batch deltas against the state table, then the writers.

    The work is that of the batch operator, so neither the batch nor an entity's share of it is
    bounded; of the state only the batch's own entities are read. The deltas are persisted: the
    state and every writer see the same ones.
    """
    def handle(rows: DataFrame, batch: Batch) -> None:
        if state.handled(rows.sparkSession, batch):
            return  # the state is committed last, so the writers have had it
        rows = rows.persist()
        like = rows.select(
            F.col(entity).alias("entity"), F.col(row_id).alias("id"),
            F.col(seconds).alias("ct"), F.lit(0).cast("bigint").alias("lt"),
        )
        key = tracked_key(rows, entity, seconds)
        entities = rows.select(key.alias("entity")).filter("entity is not null").distinct()
        before = state.before(like, entities)
        deltas = lastseen.last_seen(
            rows, entity, seconds, row_id, threshold, state=before, result=result
        ).persist()
        try:
            for write in writers.values():
                write(deltas, batch)
            state.write(lastseen.state_table(deltas, entity, seconds, row_id, result), batch)
        finally:
            deltas.unpersist()
            rows.unpersist()
    return handle


def without_replays(rows: DataFrame, event_time: str, row_id: str, horizon: str) -> DataFrame:
    """Drop an event that comes again within ``horizon``; older ids are forgotten."""
    return rows.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([row_id])
