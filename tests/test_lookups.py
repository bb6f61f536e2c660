import base64
import random

import pytest
from pyspark.sql import functions as F

from sightline.functions import vectors
from sightline.operators import aggregates, enrich, reconcile, similarity


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lookup_hit_miss_null_and_duplicate_keys(spark, conf, threshold):
    """The same rows whether Spark broadcasts the dimension or shuffles both sides."""
    conf(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__adaptive__autoBroadcastJoinThreshold=threshold)
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, 0), (4, None), (5, 10)], "id int, year int")
    dim = spark.createDataFrame([(10, 1, 2), (10, 3, 1), (0, 9, 9), (12, 5, 5), (11, None, 7)], "year int, brand int, model int")
    keyed = facts.withColumn("year", enrich.masked_key(F.col("year")))
    out = enrich.lookup(keyed, dim, ["year"], {"brand": -1, "model": -1}).orderBy("id").collect()
    assert [(r.id, r.brand, r.model) for r in out] == [(1, 3, 1), (2, -1, 7), (3, -1, -1), (4, -1, -1), (5, 3, 1)]


def test_lookup_forces_no_broadcast(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    facts, dim = spark.range(100), spark.range(10).select("id", F.lit(1).alias("v"))
    plan = enrich.lookup(facts, dim, ["id"], {"v": -1})._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_lookup_by_part_type(spark):
    facts = spark.createDataFrame([(1, 1, 5), (2, 2, 5), (3, -1, 5), (4, 1, 6)], "id int, part int, year int")
    head = spark.createDataFrame([(5, 50)], "year int, brand int")
    tail = spark.createDataFrame([(5, 60)], "year int, brand int")
    out = enrich.lookup_by_part(facts, {1: head, 2: tail}, "part", ["year"], {"brand": -1})
    assert [r.brand for r in out.orderBy("id").collect()] == [50, 60, -1, -1]


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(2,), (4,), (4,)], "k int")
    out = {r.k: (r.n_primary, r.n_shadow) for r in reconcile.missing(a, b, "k").collect()}
    assert out == {1: (1, 0), 3: (1, 0), 4: (0, 2)}
    assert sorted(r.k for r in reconcile.lost_rows(a, b, "k").collect()) == [1, 3]


def test_distinct_per_day(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "d int, e string")
    assert {r.d: r.n_entities for r in aggregates.distinct_per_day(df, "d", "e").collect()} == {1: 2, 2: 0}
    assert {r.d: r.n_entities for r in aggregates.distinct_per_day(df, "d", "e", True).collect()} == {1: 2, 2: 0}


def encoded(values):
    return base64.b64encode(bytes(values)).decode()


def test_byte_distance(spark):
    rows = [
        (encoded([255, 1]), encoded([0, 2]), 255 * 255 + 1),
        (encoded([1, 2, 3]), encoded([1, 2]), None),  # unequal lengths
        (encoded([1]), "***", None), (None, encoded([1]), None), (encoded([7]), None, None), ("", "", 0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, want bigint").repartition(1)
    for r in df.withColumn("got", vectors.byte_distance("a", "b")).collect():
        assert r.got == r.want, r


@pytest.mark.parametrize("distance", [vectors.squared_distance, vectors.array_distance])
def test_array_distance(spark, distance):
    rows = [
        ([1.0, 2.0], [0.0, 4.0], 5.0), ([1.0], [1.0, 2.0], None), (None, [1.0], None), ([], [], 0.0),
        ([1.0, None], [1.0, 1.0], None), ([3.0], [0.0], 9.0), ([1.0, 2.0, 3.0], [3.0, 2.0, 1.0], 8.0), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>, want double").repartition(1)
    for r in df.withColumn("got", distance(F.col("a"), F.col("b"))).collect():
        assert r.got == r.want, r


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_top_k_of_a_hot_category(spark, conf, broadcast_bytes):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rng = random.Random(5)
    table = [(i, rng.choice([1, 1, 1, 2]), encoded([rng.randrange(256) for _ in range(8)])) for i in range(500)]
    queries = [(q, c, encoded([rng.randrange(256) for _ in range(8)])) for q, c in ((1, 1), (2, 1), (3, 2), (4, 9))]
    out = similarity.top_k(
        spark.createDataFrame(queries, "query_id int, category int, q string"),
        spark.createDataFrame(table, "id int, category int, f string"),
        ["category"], "query_id", "q", "id", "f", k=7, distance=vectors.byte_distance,
        broadcast_bytes=broadcast_bytes,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" if broadcast_bytes else "SortMergeJoin") in plan
    want = set()
    for q, c, text in queries:
        vec = base64.b64decode(text)
        scored = sorted(
            (sum((a - b) ** 2 for a, b in zip(vec, base64.b64decode(f))), i) for i, cc, f in table if cc == c
        )
        want |= {(q, i, d, n + 1) for n, (d, i) in enumerate(scored[:7])}
    assert {(r.query_id, r.id, r.similarity, r.position) for r in out.collect()} == want


def test_top_k_limits_before_the_shuffle(spark):
    table = spark.range(10).select("id", F.lit(1).alias("c"), F.array(F.lit(1.0)).alias("v"))
    queries = spark.range(1).select(F.col("id").alias("q"), F.lit(1).alias("c"), F.array(F.lit(2.0)).alias("w"))
    plan = similarity.top_k(queries, table, ["c"], "q", "w", "id", "v", k=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_query_lines(spark):
    lines = spark.createDataFrame([("f==,12,3",), ("f",), ("f,x,4,extra",), ("",)], "value string")
    out = [tuple(r) for r in similarity.parse_queries(lines).collect()]
    assert out == [("f==", 12, 3), ("f", None, None), ("f", None, 4), ("", None, None)]


def test_category_filter_is_pushed_down(spark, folder):
    spark.range(10).select("id", F.lit(1).alias("model"), F.lit(2).alias("brand")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    plan = rows.filter(similarity.category_filter(F.col("model"), F.col("brand"), 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(model,1)" in plan and "EqualTo(brand,2)" in plan
