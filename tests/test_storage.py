import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.operators import cells, documents, lists
from sightline.sinks import indexes, messages, tables
from sightline.sinks.snapshots import Snapshots
from sightline.sources import folders
from sightline.streaming.run import Batch


def test_cells_latest_and_all_versions(spark):
    wide = spark.createDataFrame(
        [("1a", 5, "x", None), ("1a", 9, "y", "q"), ("1a", 9, "y", "q"), ("1a", 7, "z", "r"), ("2b", 1, None, None)],
        "rowkey string, version bigint, c1 string, c2 string",
    )
    stored = cells.to_cells(wide, "rowkey", "version", ["c1", "c2"])
    assert stored.count() == 7
    assert [tuple(r) for r in cells.latest(stored, ["c1", "c2"]).collect()] == [("1a", "y", "q")]
    wanted = spark.createDataFrame([("a1",), ("a1",), ("zz",)], "k string")
    found = cells.all_versions(stored.distinct(), wanted, "k")
    assert found.filter("qualifier = 'c1'").count() == 3


def test_list_positions_of_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b"]), rng.randrange(40), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, t bigint, i bigint").repartition(5)
    out = lists.pushed(df, F.col("k"), F.col("i"), [F.col("t"), F.col("i")]).collect()
    assert len(out) == 900
    for key in ("hot", "a", "b"):
        want = [i for _, _, i in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]), reverse=True)]
        have = [r.value for r in sorted((r for r in out if r.list_key == key), key=lambda r: r.position)]
        assert have == want
    listed = spark.createDataFrame(out)
    page = {r.list_key: r["values"] for r in lists.page(listed, 1, 3).collect()}
    assert all(len(v) == 3 for v in page.values())


def test_documents_upsert_and_patch(spark, folder):
    rows = spark.createDataFrame([("1", 3, "old"), ("1", 5, "new"), ("2", 1, None)], "id string, v bigint, name string")
    docs = documents.to_documents(rows, "id", F.lit("pass201609"), F.col("v"), ["id", "name"])
    indexes.write_monthly(docs, Batch("a", 0), folder)
    indexes.write_monthly(docs, Batch("a", 1), folder)  # sent twice
    before = sorted(map(tuple, indexes.read(spark, folder).collect()))
    indexes.compact(spark, folder)
    compacted = indexes.read(spark, folder)
    assert sorted(map(tuple, compacted.collect())) == before
    assert "Aggregate" not in compacted._jdf.queryExecution().executedPlan().toString()
    out = {r.doc_id: r.body for r in indexes.read(spark, folder).collect()}
    assert out == {"1": '{"id":"1","name":"new"}', "2": '{"id":"2"}'}

    base = spark.createDataFrame([(1, "a", 68), (2, "b", 70), (3, "c", 75)], "id int, name string, age int")
    patches = spark.createDataFrame([(1, 77, None, 1), (1, 78, None, 2), (3, None, "z", 1)], "id int, age int, name string, v int")
    patched = documents.patch(base, documents.latest_patch(patches, "id", ["v"]), "id")
    assert [tuple(r) for r in patched.orderBy("id").collect()] == [(1, "a", 78), (2, "b", 70), (3, "z", 75)]


BODY = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("size", T.IntegerType())])


def load(spark, first, last, version=1):
    rows = spark.range(first, last).select(
        F.col("id").cast("string"), F.concat(F.lit("n"), "id").alias("name"), F.lit(version).alias("size"), (F.col("id") % 3).alias("m")
    )
    return documents.to_documents(rows, "id", F.concat(F.lit("pass 2016/0"), "m"), F.lit(version), ["id", "name", "size"])


def patches(spark, ids, version, **fields):
    rows = [(f"pass 2016/0{i % 3}", str(i), version) for i in ids]
    df = spark.createDataFrame(rows, "index_name string, doc_id string, version bigint")
    return df.select("*", *[F.lit(v).alias(k) for k, v in fields.items()])


def bodies(spark, folder, version=None):
    rows = indexes.read(spark, folder, version).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {int(r.doc_id): r.body for r in rows}


def test_index_loads_patches_and_compactions(spark, folder):
    indexes.write_monthly(load(spark, 0, 60), Batch("a", 0), folder, 2)
    indexes.compact(spark, folder)
    indexes.patch_monthly(patches(spark, [3, 4, 999], 0, name="patched"), BODY, Batch("p", 0), folder)
    indexes.patch_monthly(patches(spark, [4], 1, size=9).union(patches(spark, [4], 2, size=8)), BODY, Batch("p", 1), folder)
    indexes.patch_monthly(patches(spark, [4], 1, size=7), BODY, Batch("p", 1), folder)  # replayed
    before = bodies(spark, folder)
    assert before[3] == '{"id":"3","name":"patched","size":1}' and before[4] == '{"id":"4","name":"patched","size":8}'
    assert len(before) == 60
    base = dict(Snapshots(folder).newest(spark).parts["base"])
    indexes.compact(spark, folder)
    assert bodies(spark, folder) == before
    after = Snapshots(folder).newest(spark).parts
    # one bucket per patched document was written again, the others are the files they were
    assert after["fresh"] == [] and sum(after["base"][k] != base[k] for k in base) == 2 and set(after["base"]) == set(base)
    indexes.write_monthly(load(spark, 50, 70, version=3), Batch("a", 1), folder)
    assert bodies(spark, folder)[55] == '{"id":"55","name":"n55","size":3}' and len(bodies(spark, folder)) == 70


def test_a_reader_stays_on_its_version(spark, folder):
    indexes.write_monthly(load(spark, 0, 20), Batch("a", 0), folder, 2)
    indexes.compact(spark, folder)
    began = Snapshots(folder).newest(spark).version
    reader = indexes.read(spark, folder)
    indexes.write_monthly(load(spark, 0, 40, version=2), Batch("a", 1), folder)
    indexes.compact(spark, folder)
    assert reader.count() == 20 and {'"size":1' in r.body for r in reader.collect()} == {True}
    assert bodies(spark, folder, began).keys() == set(range(20))


@pytest.mark.parametrize("step", [0, 1, 3, 7])
def test_a_compaction_cut_off_anywhere_loses_nothing(spark, folder, monkeypatch, step):
    indexes.write_monthly(load(spark, 0, 30), Batch("a", 0), folder, 2)
    indexes.compact(spark, folder)
    indexes.write_monthly(load(spark, 20, 40, version=2), Batch("a", 1), folder)
    before, calls = bodies(spark, folder), []
    assert len(before) == 40

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
        if step == 7:
            patched.setattr(indexes, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            indexes.compact(spark, folder)
        except RuntimeError:
            pass
        assert bodies(spark, folder) == before
    indexes.compact(spark, folder)
    assert bodies(spark, folder) == before
    indexes.write_monthly(load(spark, 40, 45), Batch("a", 2), folder)
    indexes.compact(spark, folder)
    assert len(bodies(spark, folder)) == 45


def test_a_second_writer_is_refused(spark, folder):
    table = Snapshots(folder)
    state = table.newest(spark)
    table.commit(spark, state, {"a": 1})
    with pytest.raises(FileExistsError):
        table.commit(spark, state, {"a": 2})
    assert table.newest(spark).parts == {"a": 1}


def test_search(spark):
    docs = spark.createDataFrame([("p", 68), ("p", 70), ("p", 80), ("q", 69)], "name string, age int")
    term, between = F.col("name") == "p", F.col("age").between(67, 78)
    assert [tuple(r) for r in documents.search(docs, term, between, ["age"], 1).collect()] == [("p", 68)]
    assert tuple(documents.hit_counts(docs, term, between).first()) == (3, 2)


def test_messages_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert sorted(r.value for r in messages.as_json(df).collect()) == ['{"a":1}', '{"a":2,"b":"x"}']


def test_insert_goes_by_name_and_gathers_files(spark, folder):
    rows = spark.range(1000).repartition(8).select((F.col("id") % 3).cast("int").alias("dateid"), "id")
    name = tables.create(spark, "t_" + folder.rsplit("-", 1)[1], rows, folder, ["dateid"])
    tables.insert(spark, name, rows, ["dateid"])
    tables.insert(spark, name, rows, ["dateid"])
    assert spark.table(name).columns == ["id", "dateid"]
    assert spark.table(name).filter("id % 3 != dateid").count() == 0
    assert {r.n_files for r in tables.files_per_partition(spark.table(name), ["dateid"]).collect()} == {2}


def test_gzip_files(spark, folder):
    import glob

    tables.append(spark.range(10).withColumn("d", F.lit(1)), folder, ["d"], compression="gzip", max_records=4)
    assert len(glob.glob(f"{folder}/d=1/*.gz.parquet")) >= 3


def test_partition_filter_prunes(spark, folder):
    tables.append(spark.range(100).withColumn("dateid", (F.col("id") % 5).cast("int")), folder, ["dateid"])
    plan = spark.read.parquet(folder).filter("dateid = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dateid" in plan
