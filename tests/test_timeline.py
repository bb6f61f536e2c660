import random

import pytest
from pyspark.sql import functions as F

from sightline import plans
from sightline.operators import asof, ordered

SCHEMA = "id bigint, entity string, capture_time bigint"
DAY = 86_400


def random_rows(seed, n=300):
    rng = random.Random(seed)
    return [
        (i, rng.choice(["a", "a", "a", "b", None]), rng.choice([rng.randrange(4) * DAY, rng.randrange(9 * DAY)]))
        for i in range(n)
    ]


def test_next_sighting_over_days(spark):
    rows = random_rows(1)
    late, seen = rows[:200], rows[100:]
    out = asof.next_sighting(spark.createDataFrame(late, SCHEMA), spark.createDataFrame(seen, SCHEMA))
    want = {}
    for rid, entity, t in late:
        later = sorted((s, i) for i, e, s in seen if e == entity and e is not None and s > t)
        want[rid] = (later[0][1], later[0][0]) if later else (None, None)
    assert {r.id: (r.next_id, r.next_time) for r in out.collect()} == want


def test_next_sighting_within_limit(spark):
    rows = spark.createDataFrame([(1, "a", 100), (2, "a", 400), (3, "a", 1000)], SCHEMA)
    out = {r.id: r.next_id for r in asof.next_sighting(rows, rows, within=300).collect()}
    assert out == {1: 2, 2: None, 3: None}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours_across_partitions(spark, conf, parts):
    """Groups, and the groups nearest to them, are cut by partition bounds at any place."""
    conf(spark__sql__shuffle__partitions=parts, spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(parts)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(12)]), rng.randrange(200), rng.random() < 0.5) for _ in range(300)]
    rows += [("hot", 5, i, i % 2 == 0) for i in range(200)]  # one second that fills partitions
    for forward in (False, True):
        points = spark.createDataFrame(rows, "entity string, sec bigint, id bigint, seen boolean").withColumn(
            "row", F.when(~F.col("seen") | (F.col("id") % 2 == 0), F.struct(F.col("entity").alias("e"), F.col("sec").alias("s"), F.col("id").alias("i")))
        )
        got = sorted(map(str, map(tuple, ordered.neighbours(points.repartition(4), forward).collect())))
        want = []
        for e, s, i, seen in rows:
            if seen and i % 2:
                continue
            known = [(t, j) for x, t, j, w in rows if w and x == e and t is not None and e is not None and s is not None]
            beyond = [(t, j) for t, j in known if (t > s if forward else t < s)]
            near = (min if forward else max)((t for t, _ in beyond), default=None)
            first = min((j for t, j in known if t == s), default=None)
            want.append((e, s, i, first, near, min((j for t, j in beyond if t == near), default=None)))
        assert got == sorted(map(str, want))


@pytest.mark.parametrize("plan", ["last_seen_lag", "asof_forward"])
def test_neighbours_take_one_shuffle(spark, plan):
    df = plans.QUERIES[plan](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()  # what is left after the ordering


def test_running_max_over_chunks(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "b"]), rng.randrange(1000)) for i in range(400)]
    out = asof.running_max(spark.createDataFrame(rows, SCHEMA), "entity", "id", "capture_time", "top", chunk=16)
    for r in out.collect():
        assert r.top == max((t for i, e, t in rows if e == r.entity and i < r.id), default=None)


def test_late_class(spark):
    df = spark.createDataFrame([(None,), (0,), (5,), (-1,), (-359,), (-360,)], "delta bigint")
    assert [r[0] for r in df.select(asof.late_class(F.col("delta"))).collect()] == [
        "first", "on_time", "on_time", "late", "late", "history"
    ]


def test_late_neighbours(spark):
    seen = spark.createDataFrame([(10, "abcdef", 1000), (11, "abcdef", 1100), (12, "abc", 1100)], SCHEMA)
    rows = spark.createDataFrame(
        [(1, "abcdef", 900, -100), (2, "abcdef", 500, -500), (3, "abcdef", 1050, 50), (4, "abc", 900, -100)],
        SCHEMA + ", last_captured bigint",
    )
    out = {r.id: (r.last_captured, r.next_id, r.next_time) for r in asof.late_neighbours(rows, seen).collect()}
    assert out == {1: (-100, 10, 1000), 2: (-1, None, None), 3: (50, None, None), 4: (-1, None, None)}
