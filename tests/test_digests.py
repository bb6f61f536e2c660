"""Reconciliation by digests, and rolling distinct counts by sketches."""

import random

from pyspark.sql import functions as F

from sightline.operators import digests, reconcile, sketches
from sightline.sources import folders
from sightline.streaming.run import Batch

SCHEMA = "key string, day int, v int"


def stored(spark, rows, path, buckets=8):
    df = spark.createDataFrame(rows, SCHEMA)
    digests.store(df, path, "key", "day", buckets)
    return digests.read(spark, path, df.withColumn("bucket", F.lit(0)))


def test_only_differing_buckets_are_read(spark, folder):
    rng = random.Random(1)
    rows = [(f"k{i}", 20240101 + i % 5, i) for i in range(2000)] + [(None, 20240101, 0), ("none", None, 1)]
    other = [r for r in rows if r[0] not in ("k700", "k1001")] + rows[:300] + [("new", 20240103, 5)]  # copies do not matter
    rng.shuffle(other)
    one, two = stored(spark, rows, f"{folder}/a"), stored(spark, other, f"{folder}/b")
    apart = digests.differing(spark, f"{folder}/a", f"{folder}/b", "day")
    assert 1 <= apart.count() <= 3
    got = digests.missing(one, two, f"{folder}/a", f"{folder}/b", "key", "day")
    assert sorted(map(tuple, got.collect())) == [("k1001", 1, 0), ("k700", 1, 0), ("new", 0, 1)]
    want = reconcile.missing(one.filter("key is not null"), two.filter("key is not null"), "key")
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))
    near = digests.within(one, apart, "day")
    assert near.select(F.input_file_name()).distinct().count() <= 3 < one.select(F.input_file_name()).distinct().count()
    assert "bucket" in near._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:400]


def test_files_do_not_grow_with_the_number_of_parts(spark, folder):
    rows = [(f"k{i}", i % 150, i) for i in range(1500)]
    one, two = stored(spark, rows, f"{folder}/a", 4), stored(spark, rows[::3], f"{folder}/b", 4)
    assert one.select(F.input_file_name()).distinct().count() < 60
    got = digests.missing(one, two, f"{folder}/a", f"{folder}/b", "key", "day")
    assert {r.key for r in got.collect()} == {r[0] for i, r in enumerate(rows) if i % 3}


def test_equal_tables_read_no_rows_and_many_differences_are_joined(spark, folder, monkeypatch):
    rows = [(f"k{i}", 20240101 + i % 3, i) for i in range(300)]
    one, two = stored(spark, rows, f"{folder}/a"), stored(spark, rows[::-1], f"{folder}/b")
    assert digests.missing(one, two, f"{folder}/a", f"{folder}/b", "key", "day").collect() == []
    three = stored(spark, rows[::2], f"{folder}/c")
    monkeypatch.setattr(digests, "NAMED", 2)
    got = digests.missing(one, three, f"{folder}/a", f"{folder}/c", "key", "day")
    assert {r.key for r in got.collect()} == {r[0] for r in rows[1::2]}
    none = stored(spark, [], f"{folder}/d")
    assert digests.missing(one, none, f"{folder}/a", f"{folder}/d", "key", "day").count() == 300


def test_rolling_sketches_over_batches(spark, folder):
    rng = random.Random(2)
    rows = [(f"e{rng.randrange(3000)}", 20240227 + d if d < 3 else 20240298 + d, 0) for d in (0, 1, 2, 3, 4, 7) for _ in range(2000)]
    rows += [(None, 20240227, 0), ("x", None, 0)] + [("hot", 20240228, 0)] * 3000
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    table = sketches.DaySketches(folder)
    assert table.rolling(spark, 3).collect() == []
    for number, part in enumerate((0, 1, 1, 2)):
        table.add(df.filter(F.pmod(F.hash("key", "day"), F.lit(3)) == part), "day", "key", Batch("r", min(number, 2) if number != 2 else 1))
    got = {r.day: r for r in table.rolling(spark, 3).collect()}
    exact = {r.day: r.n_exact for r in sketches.exact_rolling(df, "day", "key", 3).collect()}
    assert got.keys() == exact.keys()
    for day, n in exact.items():
        assert abs(got[day].n_distinct - n) <= sketches.ERROR * n + 1
    plan = table.rolling(spark, 3)._jdf.queryExecution().executedPlan().toString()
    assert folder.rsplit("/", 1)[1] in plan  # only the sketches are read
    assert len(folders.names(spark, f"{folder}/runs")) == 3
