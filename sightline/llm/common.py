"""What several operators need: tables, stored intermediate results, barriers, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline import session
from sightline.sources import folders

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most ``rows`` rows at once to Python: texts are long, ten thousand of them do not fit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, label: str, rows_to_python: int = 512) -> DataFrame:
    """Write a result to the cluster's shared folder and read it back.

    What follows does not compute it again, and a lost executor costs only the tasks it ran.
    """
    return _stored(df, session.scratch_path(df.sparkSession, label), rows_to_python)


def _stored(df: DataFrame, path: str, rows_to_python: int = 512) -> DataFrame:
    with arrow_rows(df.sparkSession, rows_to_python):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(result: DataFrame, label: str, spent: list[str]) -> DataFrame:
    """Store a result and remove the scratch folders (``session.noting``) that it was made from."""
    path = session.scratch_path(result.sparkSession, label)
    made = _stored(result, path)
    for old in spent:
        if old != path:
            folders.remove(result.sparkSession, old)
    spent[:] = [path]
    return made


#: Scratch folders of the pipeline stage that ran last.
_stage_scratch: list[str] = []


@contextmanager
def stage(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """What a pipeline stage runs in: the scratch of the stage before goes, if ``docs`` is not read from it.

    A stage's result is lazy, so its own scratch has to stay until the caller has written the result;
    the next stage is given what was written. Stages of a session run one after the other.
    """
    read_from = docs.inputFiles()
    for path in _stage_scratch:
        if not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read_from):
            folders.remove(spark, path)
    _stage_scratch.clear()
    with session.noting() as made:
        yield
    _stage_scratch.extend(made)


def barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A projection may be merged into a later one and then run once per reference, inside a lambda
    even once per element; a generator is never merged.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def whole(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


MATCHES = "array<struct<s:int,e:int,v:string,before:string,after:string>>"
#: Matches folded into one array at a time; appending to a long one would copy it each time.
FOLDED, CONTEXT = 128, 40


def find_all(text: Column, pattern: Column) -> Column:
    """Leftmost non-overlapping matches: array of (s, e, v, before, after).

    Places are in code points, the end exclusive; ``before`` has up to CONTEXT characters since the
    last match, ``after`` the next one. The pattern must not match the empty text.
    """
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(
        gaps.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("v"), F.slice(gaps, 2, 1 << 30).alias("next")
    )

    def one(acc, x):
        s = acc["at"] + F.char_length(x["gap"])
        e = s + F.coalesce(F.char_length(x["v"]), F.lit(0))
        row = F.struct(
            s.alias("s"), e.alias("e"), x["v"].alias("v"), F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(x["next"], F.lit(1)).alias("after"),
        )
        found = F.when(x["v"].isNotNull(), F.array_append(acc["found"], row)).otherwise(acc["found"])
        return F.struct(e.alias("at"), found.alias("found"))

    def some(acc, i):
        nothing = F.struct(acc["at"].alias("at"), F.array().cast(MATCHES).alias("found"))
        folded = F.aggregate(F.slice(acc["pieces"], i * FOLDED + 1, F.lit(FOLDED)), nothing, one)
        return F.transform(F.array(folded), lambda r: F.struct(
            r["at"].alias("at"), acc["pieces"].alias("pieces"), F.array_append(acc["parts"], r["found"]).alias("parts")
        ))[0]

    start = F.struct(F.lit(0).alias("at"), pieces.alias("pieces"), F.array().cast(f"array<{MATCHES}>").alias("parts"))
    rounds = F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / FOLDED).cast("int"))
    return F.aggregate(rounds, start, some, lambda acc: F.flatten(acc["parts"]))


def sized(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A narrow table to join with: broadcast if it has been counted small, else left to a shuffle."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def without(docs: DataFrame, gone: DataFrame, row_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that are not in ``gone`` (``row_id``, digest: xxhash64 of the text)."""
    gone = sized(gone.select(F.col(row_id).alias("_gone_id"), F.col("digest").alias("_gone_digest")))
    same = docs[row_id].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(whole(docs[text])) == gone["_gone_digest"])
    return docs.join(gone, same, "left_anti")


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b: bigint) can reach.

    Large-star and small-star steps (Kiveris et al. 2014) until nothing changes. Every step is a
    minimum per node, combined on the map side, and a join whose hot keys adaptive execution can
    split; its edges are written to the shared folder.
    Self-links and NULL ends are left out.
    """
    edges = stored(edges.filter("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), label)
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), label)
        large = stored(both.filter("b > a").join(least, "a").selectExpr("b a", "m b").distinct(), label)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), label)
        small = large.join(least, "a").selectExpr("explode(array(struct(b a, m b), struct(a a, m b))) e")
        before, edges = edges, stored(small.select("e.*").filter("a <> b").distinct(), label)
        # all edges lead to the least node: neither side has one that the other lacks
        if edges.join(before, ["a", "b"], "left_anti").isEmpty() and before.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def smallest_ids(nodes: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """(node, component_id) for ``nodes`` (node, least): the least ``least`` in each one's component.

    ``found`` has (node, component) of the nodes that have links; the others are their own component.
    """
    placed = nodes.join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    placed = stored(placed, label)
    ids = stored(placed.groupBy("component").agg(F.min("least").alias("component_id")), label)
    return placed.join(ids, "component").select("node", "component_id")
