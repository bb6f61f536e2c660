"""Time since an entity was last seen, with suppression of sightings that follow too soon.

The state of an entity is ``(ct, lt)``: the time of its last counted sighting and the gap
before it. For a sighting at ``t``, with ``d = t - ct``:

* an unseen entity gives 0 and starts the state at ``(t, 0)``;
* ``d > 0``, ``lt != 0`` and ``d + lt < threshold`` give -1 and leave the state alone;
* otherwise the result is ``d``; ``d >= 0`` moves the state to ``(t, d)``, and a negative ``d``
  (a late event) leaves it alone.

Rows are taken in the order (time, id). Rows whose entity is not worth tracking give -1.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline import schemas
from sightline.operators import cells, ordered, sightings
from sightline.operators.filters import valid_entity

SUPPRESSED = -1


def step(seen: bool, ct: int, lt: int, t: int, threshold: int, horizon: int | None = None) -> tuple[int, int, int]:
    """One sighting: (result, new ct, new lt). An entity not counted for longer than ``horizon`` is unseen."""
    gap = t - ct
    if not seen or (horizon is not None and gap > horizon):
        return 0, t, 0
    if gap > 0 and lt != 0 and gap + lt < threshold:
        return SUPPRESSED, ct, lt
    return (gap, t, gap) if gap >= 0 else (gap, ct, lt)


def _runs(keys: pa.Array) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys in a sorted column."""
    n = len(keys)
    cuts = np.flatnonzero(pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False))
    starts = [0, *(cuts + 1).tolist()]
    return list(zip(starts, [*starts[1:], n]))


def _walk(threshold: int, horizon: int | None = None):
    """Arrow batches of timelines sorted by (entity, seed first, second) -> counted seconds.

    Only the state of the entity at hand is kept from one batch to the next, so a timeline may
    be of any length. Suppressed seconds give no row and are skipped by bisection.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entity, seen, ct, lt = None, False, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column("entity")
            secs = batch.column("sec").to_numpy().tolist()
            repeated = batch.column("repeated").to_numpy(zero_copy_only=False).tolist()
            gaps = batch.column("seed_gap")
            seeds = {i: g for i, g in enumerate(gaps.to_pylist()) if g is not None} if gaps.null_count < len(gaps) else {}
            at, first, rest = [], [], []
            for start, end in _runs(keys):
                if start > 0 or keys[0].as_py() != entity:
                    seen = False
                i = start
                while i < end:
                    t = secs[i]
                    if i in seeds:
                        seen, ct, lt = True, t, seeds[i]
                        i += 1
                        continue
                    delta, ct, lt = step(seen, ct, lt, t, threshold, horizon)
                    seen = True
                    if delta == SUPPRESSED:  # or a late second at -1, which reads the same without a row
                        i = bisect_left(secs, ct + threshold - lt, i + 1, end) if t > ct else i + 1
                        continue
                    if repeated[i] and delta >= 0:
                        lt = 0  # the next row of this second comes after a gap of 0
                    at.append(i)
                    first.append(delta)
                    rest.append(min(delta, 0))
                    i += 1
            entity = keys[-1].as_py()
            picked = batch.select(["entity", "sec", "first_id"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(first, pa.int64()), pa.array(rest, pa.int64())],
                names=["entity", "sec", "first_id", "first_delta", "rest_delta"],
            )
    return run


def counted_seconds(
    timeline: DataFrame, threshold: int, state: DataFrame | None = None, horizon: int | None = None
) -> DataFrame:
    """(entity, sec, first_id, first_delta, rest_delta) of every second that is not suppressed.

    ``state`` (entity, ct, lt) seeds the walk. Timelines are sorted by Spark and streamed, so a
    task holds one Arrow batch; the longest timeline is bounded by its time span in seconds.
    """
    points = timeline.withColumn("seed_gap", F.lit(None).cast("bigint"))
    if state is not None:
        id_type = timeline.schema["first_id"].dataType
        points = points.unionByName(
            state.select(
                "entity", F.col("ct").alias("sec"), F.lit(None).cast(id_type).alias("first_id"),
                F.lit(False).alias("repeated"), F.col("lt").alias("seed_gap"),
            )
        )
    schema = T.StructType(
        [timeline.schema["entity"], T.StructField("sec", T.LongType()), timeline.schema["first_id"],
         T.StructField("first_delta", T.LongType()), T.StructField("rest_delta", T.LongType())]
    )
    return (
        points.repartition("entity")
        .sortWithinPartitions("entity", F.col("seed_gap").isNull(), "sec")
        .mapInArrow(_walk(threshold, horizon), schema)
    )


def last_seen(
    rows: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    threshold: int = schemas.SUPPRESS_SECONDS_V2,
    valid: Column | None = None,
    state: DataFrame | None = None,
    result: str = "last_captured",
    horizon: int | None = None,
) -> DataFrame:
    """Add the last-seen delta to every row; with ``horizon`` an entity unseen for longer starts anew.

    Three narrow steps carry the work: distinct seconds (pre-aggregated, shuffled by entity and
    second), the ordered walk, and the join back. Full rows are shuffled once, for the join.
    """
    good = tracked_key(rows, entity, seconds, valid)
    timeline = sightings.distinct_seconds(
        rows.select(good.alias("_entity"), seconds, row_id), "_entity", seconds, row_id
    )
    counted = counted_seconds(timeline, threshold, state, horizon)
    joined = sightings.attach(rows, counted, good, seconds)
    delta = F.when(F.col(row_id) == F.col("first_id"), F.col("first_delta")).otherwise(F.col("rest_delta"))
    return joined.withColumn(result, F.coalesce(delta, F.lit(SUPPRESSED).cast("bigint"))).drop(
        "first_id", "first_delta", "rest_delta"
    )


def tracked_key(rows: DataFrame, entity: str, seconds: str, valid: Column | None = None) -> Column:
    """The entity where it is worth tracking, else NULL."""
    if valid is None:
        valid = valid_entity(F.col(entity), F.col(seconds))
    return F.when(valid, F.col(entity))


def last_seen_simple(
    rows: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    result: str = "last_captured",
) -> DataFrame:
    """The plain delta: 1 for an unseen entity, the gap when later than before, else 0."""
    points = rows.select(
        F.col(entity).alias("entity"), F.col(seconds).cast("bigint").alias("sec"), F.col(row_id).alias("id"),
        F.lit(True).alias("seen"), F.struct(*rows.columns).alias("row"),
    )
    found = ordered.neighbours(points, forward=False)
    gap = F.coalesce(F.col(seconds).cast("bigint") - F.col("near_sec"), F.lit(1))
    delta = F.when(F.col(row_id) == F.col("first_id"), gap).otherwise(F.lit(0))
    return found.withColumn(result, delta.cast("bigint")).select(*rows.columns, result)


def state_table(
    deltas: DataFrame,
    entity: str = "entity",
    seconds: str = "capture_time",
    row_id: str = "id",
    delta: str = "last_captured",
) -> DataFrame:
    """(entity, id, ct, lt): the last row per entity that moved the state; last write wins."""
    return (
        deltas.filter(F.col(delta) >= 0)
        .groupBy(F.col(entity).alias("entity"))
        .agg(F.max(F.struct(F.col(seconds).alias("ct"), F.col(row_id).alias("id"), F.col(delta).alias("lt"))).alias("s"))
        .select("entity", "s.id", "s.ct", "s.lt")
    )


def merge_state(before: DataFrame, moved: DataFrame) -> DataFrame:
    """The state after a batch: entities that moved take their new row."""
    rows = before.withColumn("_age", F.lit(0)).unionByName(moved.withColumn("_age", F.lit(1)))
    newest = rows.groupBy("entity").agg(F.max(F.struct("_age", "ct", "id", "lt")).alias("s"))
    return newest.select("entity", "s.id", "s.ct", "s.lt")


def state_cells(state: DataFrame) -> DataFrame:
    """State rows as text cells under the reversed entity, versioned by ``ct``."""
    wide = state.select(
        F.reverse("entity").alias("rowkey"), F.col("ct").alias("version"),
        F.col("id").cast("string").alias("id"), F.col("ct").cast("string").alias("ct"),
        F.col("lt").cast("string").alias("lt"),
    )
    return cells.to_cells(wide, "rowkey", "version", ["id", "ct", "lt"])
