"""Neighbours of rows in one ordering.

Rows are ordered once, by (entity, second, id), over range partitions: a hot entity is cut at its
seconds. A task walks its sorted rows; what it must know of the partitions before is one row, the
last group of each partition with its neighbour, and these are folded on the driver, one for every
partition. So there is one shuffle, no join back, and no window over an entity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline import session


class Carry(NamedTuple):
    """Where a walk stands: its last group (entity, sec), that group's first id, and the seen group nearest to it."""

    entity: object
    sec: int
    first_id: object
    seen: bool
    near_sec: int | None
    near_id: object


def _after(before: Carry | None, own: Carry) -> Carry:
    """Where a walk stands that comes from ``before`` over a partition that alone ends at ``own``."""
    if before is None or before.entity != own.entity:
        return own
    if own.sec == before.sec:  # one group so far; its first row came before
        return before
    if own.near_sec is None:
        near = (before.sec, before.first_id) if before.seen else (before.near_sec, before.near_id)
        return own._replace(near_sec=near[0], near_id=near[1])
    if own.near_sec == before.sec and before.seen:
        return own._replace(near_id=before.first_id)
    return own


class _Walk:
    """Groups of (entity, sec) in sorted batches, each with the nearest group before it that was seen."""

    def __init__(self, carry: Carry | None):
        self.carry = carry

    def over(self, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, pa.Array]:
        """For every row the first id of its group, and second and id of the nearest seen group."""
        entity, sec, ids, seen = (batch.column(c) for c in ("entity", "sec", "id", "seen"))
        extra = 0
        if self.carry is not None:  # as up to two rows in front
            c = self.carry
            head = [(c.entity, c.near_sec, c.near_id, True)] if c.near_sec is not None else []
            head.append((c.entity, c.sec, c.first_id, c.seen))
            extra = len(head)
            front = [pa.array([h[i] for h in head], a.type) for i, a in enumerate((entity, sec, ids, seen))]
            entity, sec, ids, seen = (pa.concat_arrays([f, a]) for f, a in zip(front, (entity, sec, ids, seen)))
        n, when = len(sec), sec.to_numpy()
        new_entity = np.ones(n, dtype=bool)
        new_entity[1:] = pc.not_equal(entity.slice(1), entity.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new_group = new_entity.copy()
        new_group[1:] |= when[1:] != when[:-1]
        starts, group = np.flatnonzero(new_group), np.cumsum(new_group) - 1
        numbers = np.arange(len(starts))
        own = np.maximum.accumulate(np.where(new_entity[starts], numbers, 0))  # the entity's first group
        was_seen = seen.to_numpy(zero_copy_only=False)[starts]
        last = np.maximum.accumulate(np.where(was_seen, numbers, -1))
        near = np.concatenate([[-1], last[:-1]])
        known = near >= own
        near_rows = pa.array(starts[np.maximum(near, 0)], mask=~known)
        first_rows = pa.array(starts, mask=~was_seen)
        g = group[-1]
        at = int(starts[near[g]]) if known[g] else None
        self.carry = Carry(
            entity[n - 1].as_py(), int(when[-1]), ids[int(starts[g])].as_py(), bool(was_seen[g]),
            int(when[at]) if at is not None else None, ids[at].as_py() if at is not None else None,
        )
        rows = pa.array(group[extra:])
        return ids.take(first_rows.take(rows)), sec.take(near_rows.take(rows)), ids.take(near_rows.take(rows))


def neighbours(points: DataFrame, forward: bool) -> DataFrame:
    """(row.*, first_id, near_sec, near_id) for the ``points`` (entity, sec, id, seen, row) that have a row.

    ``first_id`` is the least id seen in the row's own second, ``near_sec`` and ``near_id`` are the nearest
    earlier (with ``forward`` later) second in which its entity was seen, and the least id there.
    Rows without entity or second have none of them. The sorted rows are checkpointed in the shared
    folder, because both walks must find the same partitions.
    """
    session.shared_root(points.sparkSession)
    by_time = F.col("sec").desc() if forward else F.col("sec").asc()
    placed = F.col("entity").isNotNull() & F.col("sec").isNotNull()
    # what is seen comes first in its second, so the group's first row has its least id
    order = [F.col("entity"), by_time, F.col("seen").desc(), F.col("id").asc_nulls_last()]
    ordered = points.filter(placed).repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()

    kinds = [T.StructField(n, ordered.schema[c].dataType) for n, c in (
        ("entity", "entity"), ("sec", "sec"), ("first_id", "id"), ("seen", "seen"), ("near_sec", "sec"), ("near_id", "id"))]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, schema = _Walk(None), None
        for batch in batches:
            if batch.num_rows:
                walk.over(batch)
                schema = batch.schema
        if walk.carry is not None:
            names = ("entity", "sec", "id", "seen", "sec", "id")
            arrays = [pa.array([v], schema.field(c).type) for v, c in zip(walk.carry, names)]
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([part, *arrays], names=["part", *Carry._fields])

    ends = ordered.select("entity", "sec", "id", "seen").mapInArrow(last, T.StructType([T.StructField("part", T.IntegerType()), *kinds]))
    carry: dict[int, Carry] = {}
    stand = None
    for row in sorted(ends.collect(), key=lambda r: r.part):
        carry[row.part] = stand
        stand = _after(stand, Carry(*row[1:]))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(carry.get(TaskContext.get().partitionId()))
        for batch in batches:
            if batch.num_rows:
                found = pa.RecordBatch.from_arrays(
                    [batch.column("row"), *walk.over(batch)], names=["row", "first_id", "near_sec", "near_id"]
                )
                yield found.filter(pc.is_valid(batch.column("row")))

    row, none = points.schema["row"], F.lit(None)
    named = [T.StructField(n, points.schema[c].dataType) for n, c in (("first_id", "id"), ("near_sec", "sec"), ("near_id", "id"))]
    found = ordered.mapInArrow(walked, T.StructType([row, *named]))
    rest = points.filter(~placed & F.col("row").isNotNull()).select(
        "row", *[none.cast(f.dataType).alias(f.name) for f in named]
    )
    return found.union(rest).select("row.*", "first_id", "near_sec", "near_id")
