"""Last-seen against a row-by-row simulation, in batch, resumed and streaming form."""

import random

import pytest
from pyspark.sql import functions as F

from sightline.operators import lastseen
from sightline.sinks import tables
from sightline.sources import stream
from sightline.streaming import lastseen as streaming
from sightline.streaming import run

SCHEMA = "id bigint, entity string, capture_time bigint"
T = 1000


def tracked(entity):
    return entity is not None and 6 <= len(entity) <= 10 and "无" not in entity and "未" not in entity


def simulate(batches, threshold=T):
    """{id: delta} with each batch taken by (time, id), one event at a time."""
    state, out = {}, {}
    for batch in batches:
        for rid, entity, t in sorted(set(batch), key=lambda r: (r[2], r[0])):
            if not tracked(entity):
                out[rid] = -1
            elif entity not in state:
                out[rid] = 0
                state[entity] = (t, 0)
            else:
                ct, lt = state[entity]
                d = t - ct
                if d > 0 and lt != 0 and d + lt < threshold:
                    out[rid] = -1
                else:
                    out[rid] = d
                    if d >= 0:
                        state[entity] = (t, d)
    return out, state


def random_rows(seed, n=600, span=20_000, start_id=0):
    rng = random.Random(seed)
    names = [None, "", "E1", "E无00001", "E未00001", "E0000000001", "E000001", "E000002", "E000003"]
    weights = [1, 1, 1, 1, 1, 1, 12, 4, 2]  # E000001 has about half of all rows
    return [
        (start_id + i, rng.choices(names, weights)[0], rng.choice([rng.randrange(span), rng.randrange(50) * 400]))
        for i in range(n)
    ]


def got(df):
    rows = df.select("id", "last_captured").collect()
    out = {r.id: r.last_captured for r in rows}
    return out, len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_batch_equals_simulation(spark, seed):
    rows = random_rows(seed)
    deltas, n = got(lastseen.last_seen(spark.createDataFrame(rows, SCHEMA), threshold=T))
    assert n == len(rows)
    assert deltas == simulate([rows])[0]


def test_walk_carries_state_across_arrow_batches(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=7)
    rows = random_rows(11)
    assert got(lastseen.last_seen(spark.createDataFrame(rows, SCHEMA), threshold=T))[0] == simulate([rows])[0]


def test_copies_of_an_event_get_one_answer(spark):
    rows = [(1, "E000001", 100), (2, "E000001", 150), (2, "E000001", 150), (3, "E000001", 160)]
    out = lastseen.last_seen(spark.createDataFrame(rows, SCHEMA), threshold=T).orderBy("id").collect()
    assert [r.last_captured for r in out] == [0, 50, 50, -1]


def test_resumed_state_with_late_rows(spark):
    first, second = random_rows(5), random_rows(6, start_id=10_000)
    want, want_state = simulate([first, second])
    one = lastseen.last_seen(spark.createDataFrame(first, SCHEMA), threshold=T)
    state = lastseen.state_table(one)
    two = lastseen.last_seen(spark.createDataFrame(second, SCHEMA), threshold=T, state=state)
    assert {**got(one)[0], **got(two)[0]} == want
    merged = lastseen.merge_state(state, lastseen.state_table(two))
    assert {r.entity: (r.ct, r.lt) for r in merged.collect()} == want_state


def test_hot_second_is_split_by_adaptive_execution(spark, conf):
    """A third of all rows in one second of one entity: the join back is split, and stays right."""
    conf(
        spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.5,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="30KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = spark.range(120_000).repartition(8).select(
        "id", F.when(F.col("id") % 3 == 0, "E000001").otherwise(F.format_string("E%06d", F.col("id") % 997)).alias("entity"),
        F.when(F.col("id") % 3 == 0, 5000).otherwise(F.col("id")).alias("capture_time"),
    )
    out = lastseen.last_seen(rows, threshold=T)
    deltas = {r.id: r.last_captured for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    want = simulate([[tuple(r) for r in rows.collect()]])[0]
    assert deltas == want


def test_simple_delta(spark):
    rows = random_rows(7)
    out = lastseen.last_seen_simple(spark.createDataFrame(rows, SCHEMA))
    last, want = {}, {}
    for rid, entity, t in sorted(rows, key=lambda r: (r[2], r[0])):
        want[rid] = t - last[entity] if entity in last else 1
        last[entity] = t
    have = {r.id: r.last_captured for r in out.collect()}
    assert {k: v for k, v in have.items() if rows[k][1] is not None} == {
        k: v for k, v in want.items() if rows[k][1] is not None
    }


def test_stream_equals_simulation_over_batches_with_late_rows(spark, folder):
    batches = [random_rows(s, n=120, start_id=1000 * s) for s in (1, 2, 3)]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/b{i}")
        source = stream.files(spark, f"{folder}/in/*", SCHEMA, glob="*.parquet")
        deltas = streaming.last_seen_stream(source, threshold=T)
        run.drain(run.to_files(deltas, f"{folder}/out", f"{folder}/ckpt"))
    out, n = got(spark.read.parquet(f"{folder}/out"))
    assert n == 360
    assert out == simulate(batches)[0]


@pytest.mark.parametrize("fan", [2, 3, 50])
def test_state_table_equals_simulation_over_batches_with_late_rows(spark, folder, fan):
    batches = [random_rows(s, n=120, start_id=1000 * s) for s in (1, 2, 3, 4)]
    state = streaming.StateTable(f"{folder}/state", fan, buckets=3)
    writers = {"out": lambda df, b: tables.write_batch(df, b, f"{folder}/out")}
    handle = streaming.last_seen_batches(state, writers, threshold=T)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/b{i}")
        source = stream.files(spark, f"{folder}/in/*", SCHEMA, glob="*.parquet")
        run.drain(run.by_batch(source, handle, f"{folder}/ckpt"))
    out, n = got(spark.read.parquet(f"{folder}/out"))
    assert n == 480
    assert out == simulate(batches)[0]


def test_state_table_batch_can_run_again(spark, folder):
    state = streaming.StateTable(f"{folder}/state", 2)
    writers = {"out": lambda df, b: tables.write_batch(df, b, f"{folder}/out")}
    handle = streaming.last_seen_batches(state, writers, threshold=T)
    batches = [random_rows(s, n=80, start_id=1000 * s) for s in (1, 2, 3)]
    for b, rows in enumerate(batches):
        for _ in range(2):
            handle(spark.createDataFrame(rows, SCHEMA), run.Batch("r", b))
    out, n = got(spark.read.parquet(f"{folder}/out"))
    assert n == 240
    assert out == simulate(batches)[0]
