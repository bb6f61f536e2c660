"""Replays, fan-out, unions and chained queries."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sightline.operators import aggregates
from sightline.operators import lastseen as operators_lastseen
from sightline.plans import streams
from sightline.sinks import tables
from sightline.sources import batch, folders, stream
from sightline.streaming import lastseen, run, statetable

SCHEMA = "id bigint, day int"


def feed(spark, path, first, last):
    spark.range(first, last).select("id", (F.col("id") % 3).cast("int").alias("day")).coalesce(1).write.mode("append").parquet(path)


def counts(spark, path):
    return {r.id: r["count"] for r in spark.read.parquet(path).groupBy("id").count().collect()}


def test_restart_goes_on_where_the_checkpoint_stands(spark, folder):
    for first in (0, 50):
        feed(spark, f"{folder}/in", first, first + 50)
        for _ in range(2):
            run.drain(run.to_files(stream.files(spark, f"{folder}/in", SCHEMA), f"{folder}/out", f"{folder}/ckpt", by=["day"]))
    assert counts(spark, f"{folder}/out") == {i: 1 for i in range(100)}


def test_batch_failing_after_its_first_write_is_replayed_without_copies(spark, folder):
    feed(spark, f"{folder}/in", 0, 60)
    failures = [True]

    def second(df, batch_id):
        if failures:
            failures.pop()
            raise RuntimeError("lost")
        tables.write_batch(df, batch_id, f"{folder}/b", ["day"])

    writers = {"first": lambda df, b: tables.write_batch(df, b, f"{folder}/a", ["day"]), "second": second}
    source = stream.files(spark, f"{folder}/in", SCHEMA)
    try:
        run.drain(run.for_each(source, writers, f"{folder}/ckpt"))
        raise AssertionError("the failure was lost")
    except Exception as error:  # noqa: BLE001
        assert "lost" in str(error)
    run.drain(run.for_each(source, writers, f"{folder}/ckpt"))
    for path in ("a", "b"):
        assert counts(spark, f"{folder}/{path}") == {i: 1 for i in range(60)}


def test_fresh_checkpoint_over_the_same_sink(spark, folder):
    feed(spark, f"{folder}/in", 0, 30)
    for n in range(2):
        writers = {"rows": lambda df, b: tables.write_batch(df, b, f"{folder}/out", ["day"], unique=["id"])}
        run.drain(run.for_each(stream.files(spark, f"{folder}/in", SCHEMA), writers, f"{folder}/ckpt{n}"))
    assert counts(spark, f"{folder}/out") == {i: 1 for i in range(30)}


def drain_rows(spark, folder, feed_name, checkpoint, max_files=None, unique=None):
    writers = {"rows": lambda df, b: tables.write_batch(df, b, f"{folder}/out", ["day"], unique=unique)}
    source = stream.files(spark, f"{folder}/{feed_name}", SCHEMA, max_files=max_files)
    run.drain(run.for_each(source, writers, f"{folder}/{checkpoint}"))


def test_new_rows_under_a_new_checkpoint_are_kept_beside_the_old(spark, folder):
    feed(spark, f"{folder}/one", 0, 10)
    feed(spark, f"{folder}/two", 10, 20)
    drain_rows(spark, folder, "one", "c1")
    drain_rows(spark, folder, "two", "c2")
    assert counts(spark, f"{folder}/out") == {i: 1 for i in range(20)}


def test_other_batches_of_the_same_rows_neither_lose_nor_copy(spark, folder):
    for i in range(4):
        feed(spark, f"{folder}/in", i * 10, i * 10 + 10)
    drain_rows(spark, folder, "in", "c1", max_files=1, unique=["id"])
    feed(spark, f"{folder}/in", 40, 50)
    drain_rows(spark, folder, "in", "c2", max_files=3, unique=["id"])
    assert counts(spark, f"{folder}/out") == {i: 1 for i in range(50)}


def test_a_finished_batch_is_not_rewritten(spark, folder):
    rows, batch = spark.range(3), run.Batch("r", 0)
    tables.write_batch(rows, batch, folder)
    files = spark.read.parquet(folder).inputFiles()
    tables.write_batch(rows, batch, folder)
    assert spark.read.parquet(folder).inputFiles() == files


def test_batch_folders_of_finished_runs_are_merged(spark, folder):
    for i in range(3):
        tables.write_batch(spark.range(i * 5, i * 5 + 5).withColumn("day", F.lit(i)), run.Batch("r", i), folder, ["day"])
    for _ in range(2):
        tables.merge_batches(spark, folder, ["r"], "merged", ["day"])
        assert counts(spark, folder) == {i: 1 for i in range(15)}
    assert folders.names(spark, folder) == ["run_id=merged"]


SIGHTINGS = "id bigint, entity string, capture_time bigint"


def seen(spark, folder, rows, checkpoint, name="in"):
    df = spark.createDataFrame(rows, SIGHTINGS)
    df.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    writers = {"d": lambda d, b: tables.write_batch(d, b, f"{folder}/out")}
    handle = lastseen.last_seen_batches(lastseen.StateTable(f"{folder}/state", fan=2), writers)
    run.drain(run.by_batch(stream.files(spark, f"{folder}/{name}", SIGHTINGS, max_files=1), handle, f"{folder}/{checkpoint}"))
    return {r.id: r.last_captured for r in spark.read.parquet(f"{folder}/out").collect()}


def test_the_state_goes_on_under_a_new_checkpoint(spark, folder):
    assert seen(spark, folder, [(1, "entity1", 1_000_000)], "c1") == {1: 0}
    assert seen(spark, folder, [(2, "entity1", 1_004_000)], "c2", "in2") == {1: 0, 2: 4000}


def test_late_rows_across_batches_follow_the_rule(spark, folder):
    rng, rows = random.Random(3), []
    for i in range(120):
        rows.append((i, f"entity{rng.randrange(4)}", 1_000_000 + rng.randrange(300_000)))
    for start in range(0, 120, 30):
        got = seen(spark, folder, rows[start : start + 30], "c1")
    state, want = {}, {}
    for start in range(0, 120, 30):
        for i, e, t in sorted(rows[start : start + 30], key=lambda r: (r[2], r[0])):
            ct, lt = state.get(e, (0, 0))
            want[i], *state[e] = operators_lastseen.step(e in state, ct, lt, t, 43_200)
            state[e] = tuple(state[e])
    assert got == want


def test_the_feed_s_slicing_does_not_change_the_answer(spark, folder):
    rng = random.Random(5)
    rows = [(i, f"entity{rng.randrange(9)}", 1_000_000 + rng.randrange(90) * 2000) for i in range(200)]
    df, answers = spark.createDataFrame(rows, SIGHTINGS), []
    for parts in (1, 2, 5):
        found = streams._last_seen_over(spark, f"{folder}/{parts}", {"c": df}, parts)
        answers.append(sorted(map(tuple, found.collect())))
    assert answers[0] == answers[1] == answers[2]
    assert len(answers[0]) == 200


STATE = "entity string, id bigint, ct bigint, lt bigint"


def entities(spark, first, last, step=1, ct=10):
    name = F.concat(F.lit("e"), F.col("id").cast("string")).alias("entity")
    return spark.range(first, last, step).select(name, "id", F.lit(ct).cast("bigint").alias("ct"), F.lit(0).cast("bigint").alias("lt"))


def scanned(df):
    """Rows that the files' scans gave when ``df`` was collected."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans if s.metrics().contains("numOutputRows"))


def test_a_batch_reads_its_entities_out_of_a_large_state(spark, folder, conf):
    conf(spark__sql__adaptive__enabled="false")  # the metrics of the plan as it is
    state = lastseen.StateTable(folder, fan=2)
    for n in range(3):  # two runs are merged into buckets, the third stays beside them
        state.write(entities(spark, n * 400_000, n * 400_000 + 400_000), run.Batch("r", n))
    for wanted in (entities(spark, 0, 1_200_000, 6_000), entities(spark, 5, 1_200_000, 400_000)):
        found = state.before(entities(spark, 0, 0), wanted.select("entity"))
        assert sorted(found.collect()) == sorted(wanted.collect())
        assert scanned(found) < 0.05 * 1_200_000
    many = entities(spark, 0, 1_200_000, 100)
    assert state.before(entities(spark, 0, 0), many.select("entity")).count() == 12_000
    assert state.before(entities(spark, 0, 0), spark.createDataFrame([("nobody",)], "entity string")).count() == 0


def test_more_entities_than_can_be_named(spark, folder, monkeypatch):
    monkeypatch.setattr(statetable, "NAMED", 5)
    state = lastseen.StateTable(folder, fan=2, buckets=3)
    for n in range(3):
        state.write(entities(spark, n * 50, n * 50 + 60, ct=n), run.Batch("r", n))
    for wanted in (entities(spark, 0, 160, 20), entities(spark, 0, 200)):
        found = state.before(entities(spark, 0, 0), wanted.select("entity"))
        known = {f"e{i}": min(i // 50, 2) for i in range(160)}  # the last batch that had it
        assert {r.entity: r.ct for r in found.collect()} == {r.entity: known[r.entity] for r in wanted.collect() if r.entity in known}


def test_only_full_buckets_are_rewritten(spark, folder):
    state, like = lastseen.StateTable(folder, fan=2, buckets=4), entities(spark, 0, 0)
    for n in range(12):  # one entity over and over, another once
        state.write(entities(spark, 7, 8, ct=n).union(entities(spark, 100 + n, 101 + n)), run.Batch("r", n))
    parts = state.snapshots.newest(spark).parts
    assert len(parts["fresh"]) < 2
    for runs in parts["buckets"].values():
        levels = [level for level, _ in runs]
        assert max(levels.count(x) for x in levels) < 2 and max(levels) <= 4
    assert {r.entity: r.ct for r in state.before(like).collect()} == {"e7": 11, **{f"e{100 + n}": 10 for n in range(12)}}
    live = {r for runs in parts["buckets"].values() for _, r in runs} | set(parts["fresh"])
    kept = {path for path, _ in state.snapshots.newest(spark).retired}
    for name in folders.names(spark, f"{folder}/runs"):
        assert any(f"runs/{name}" == p or p.startswith(f"runs/{name}/") for p in live | kept)


@pytest.mark.parametrize("step", range(6))
def test_a_state_write_cut_off_anywhere_can_be_tried_again(spark, folder, monkeypatch, step):
    state, like = lastseen.StateTable(folder, fan=2, buckets=2), entities(spark, 0, 0)
    state.write(entities(spark, 0, 5, ct=1), run.Batch("r", 0))
    calls = []

    def failing(name):
        real = getattr(folders, name)

        def call(*args):
            calls.append(name)
            if len(calls) == step + 1:
                raise RuntimeError("lost")
            return real(*args)
        return call

    with monkeypatch.context() as patched:
        for name in ("write_text", "remove"):
            patched.setattr(folders, name, failing(name))
        try:
            state.write(entities(spark, 3, 9, ct=2), run.Batch("r", 1))
        except RuntimeError:
            pass
    state.write(entities(spark, 3, 9, ct=2), run.Batch("r", 1))
    assert {r.entity: r.ct for r in state.before(like).collect()} == {f"e{i}": 1 if i < 3 else 2 for i in range(9)}
    state.write(entities(spark, 0, 1, ct=3), run.Batch("r", 2))
    assert {r.entity: r.ct for r in state.before(like).collect()}["e0"] == 3


def test_a_committed_batch_is_not_written_again(spark, folder):
    state, done = lastseen.StateTable(folder), []
    handle = lastseen.last_seen_batches(state, {"out": lambda df, b: done.append(b.number)})
    rows = spark.createDataFrame([(1, "entity1", 1_000_000)], SIGHTINGS)
    for number in (0, 0, 1):
        handle(rows, run.Batch("r", number))
    assert done == [0, 1]


def test_state_of_entities_that_stay_away_is_removed(spark, folder):
    day = 86_400
    rows = [(1, "entity1", 1_000_000), (2, "entity2", 1_000_000), (3, "entity1", 1_000_000 + 2 * day), (4, "entity3", 1_000_000 + 9 * day),
            (5, "entity3", 1_000_000 + 10 * day), (6, "entity2", 1_000_000 + 11 * day), (7, "ab", 0), (8, None, 5), (9, "entity9", None)]
    schema = StructType.fromDDL(SIGHTINGS)
    held = []
    for i in range(0, 6):
        spark.createDataFrame([rows[i]] + ([*rows[6:]] if i == 0 else []), schema).coalesce(1).write.parquet(f"{folder}/in/b{i}")
        source = stream.files(spark, f"{folder}/in", SIGHTINGS, recursive=True)
        query = run.to_files(lastseen.last_seen_stream(source, horizon=3 * day), f"{folder}/out", f"{folder}/ckpt")
        run.drain(query)
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    out = {r.id: r.last_captured for r in spark.read.parquet(f"{folder}/out").collect()}
    assert out == {1: 0, 2: 0, 3: 2 * day, 4: 0, 5: day, 6: 0, 7: -1, 8: -1, 9: -1}
    assert held[1] == 2 and held[-1] <= 2  # entity1 and the old entity2 are gone


class Held:
    """A state as an update sees it."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut = None, False, False

    def update(self, value):
        self.get, self.exists = value, True


@pytest.mark.parametrize("horizon", [None, 600])
def test_an_update_makes_no_tables_besides_its_rows(monkeypatch, horizon):
    """Unordered rows, repeated ones and unknown ids in several chunks, against the rule row by row."""
    def none(*args, **kwargs):
        raise AssertionError("a table operation per group")

    rng = random.Random(3)
    batches = [[(rng.choice([None, *range(8)]), 1000 + rng.randrange(40 * (b + 1)) * 30) for _ in range(25)] for b in range(4)]
    with monkeypatch.context() as m:
        for name in ("merge", "drop_duplicates", "sort_values"):
            m.setattr(pd.DataFrame, name, none)
        monkeypatch.setattr(Held, "setTimeoutTimestamp", lambda s, t: None, raising=False)
        monkeypatch.setattr(Held, "getCurrentWatermarkMs", lambda s: 0, raising=False)
        update = lastseen._update(120, "sec", "id", "delta", ["id", "sec", "delta"], horizon)
        state, seen, ct, lt = Held(), False, 0, 0
        for batch in batches:
            chunks = [pd.DataFrame(part, columns=["id", "sec"]) for part in (batch[:10], batch[10:])]
            found = pd.concat(list(update(("entity1",), iter(chunks), state)))
            want = {}
            for t, unknown, i in sorted({(t, i is None, i or 0) for i, t in batch}):
                want[(t, None if unknown else i)], ct, lt = operators_lastseen.step(seen, ct, lt, t, 120, horizon)
                seen = True
            got = [(t, None if pd.isna(i) else int(i), d) for i, t, d in found.itertuples(index=False)]
            assert got == [(t, i, want[(t, i)]) for i, t in batch]


def test_batch_fold_with_a_horizon(spark):
    rows = [(1, "entity1", 1_000_000), (2, "entity1", 1_100_000), (3, "entity1", 1_400_001), (4, "entity1", 1_700_001)]
    found = operators_lastseen.last_seen(spark.createDataFrame(rows, SIGHTINGS), horizon=300_000)
    assert {r.id: r.last_captured for r in found.collect()} == {1: 0, 2: 100_000, 3: 0, 4: 300_000}


def test_admission_limit_makes_several_batches(spark, folder):
    for i in range(3):
        feed(spark, f"{folder}/in", i * 10, i * 10 + 10)
    query = run.to_files(stream.files(spark, f"{folder}/in", SCHEMA, max_files=1), f"{folder}/out", f"{folder}/ckpt")
    run.drain(query)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_replayed_events_are_dropped_within_the_horizon(spark, folder):
    rows = spark.createDataFrame([(1, 100), (1, 100), (2, 100), (2, 160)], "id bigint, sec bigint")
    rows.select("id", F.timestamp_seconds("sec").alias("at")).coalesce(1).write.parquet(f"{folder}/in")
    source = stream.files(spark, f"{folder}/in", "id bigint, at timestamp")
    run.drain(run.to_files(lastseen.without_replays(source, "at", "id", "1 hour"), f"{folder}/out", f"{folder}/ckpt"))
    assert counts(spark, f"{folder}/out") == {1: 1, 2: 1}


def test_union_days_with_different_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, n string"), spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in batch.union_days([a, b]).orderBy("id").collect()] == [(1, "x"), (2, None)]


def test_observed_counts(spark):
    rows, metrics = aggregates.observed(spark.range(10), "counts", even=F.col("id") % 2 == 0)
    rows.write.format("noop").mode("overwrite").save()
    assert metrics.get == {"n_rows": 10, "even": 5}


def test_asking_for_names_does_not_call_the_jvm_for_each(spark, folder, monkeypatch):
    """3,000 names, odd ones among them, in a few hundred calls; all of them are found, and no other."""
    odd = ["", "it's", "back\\slash", "E无", "a\nb", "%_"]
    names = [*odd, *(f"E{i:06d}" for i in range(3000))]
    rows = spark.createDataFrame([(n, k, 100 + k, 0) for k, n in enumerate(names)], "entity string, id bigint, ct bigint, lt bigint")
    table = statetable.StateTable(f"{folder}/state", fan=2, buckets=8)
    table.write(rows, run.Batch("r", 0))
    table.write(rows.filter("id < 10"), run.Batch("r", 1))
    asked = rows.filter("id <> 7").select("entity")
    calls, client = [], spark.sparkContext._gateway._gateway_client
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: (calls.append(1), send(*a, **k))[1])
    found = table.before(rows, asked)
    assert len(calls) < 1500
    assert sorted(r.id for r in found.collect()) == [k for k in range(len(names)) if k != 7]
