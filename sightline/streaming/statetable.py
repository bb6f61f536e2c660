"""The entities' state as a table that is read by key.

Every batch adds one run: the entities that moved, sorted by hash bucket and entity, with Bloom
filters and short pages, so that a reader who asks for entities by name skips the files without them
and, in the others, all pages but theirs. ``fan`` such runs are merged into one that is cut into a
folder per bucket; a bucket's runs are merged by levels: ``fan`` of one level make one of the next, and
the other buckets' files stay as they are. So an entity's row is rewritten once per level, and a
bucket has at most ``fan`` runs of each.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.sinks.snapshots import Manifest, Snapshots
from sightline.sources import folders
from sightline.streaming.run import Batch

#: Entities that one scan asks for by name; ``spark.sql.parquet.pushdown.inFilterThreshold`` must allow it.
NAMED = 1024
#: Scans for one batch at most.
SCANS = 64
#: How a run is written: a page is what a reader takes at least.
LAYOUT = {
    "parquet.bloom.filter.enabled#entity": "true",
    "parquet.bloom.filter.adaptive.enabled#entity": "true",
    "parquet.page.row.count.limit": "100",
    "parquet.block.size": str(16 << 20),
    "parquet.enable.dictionary#entity": "false",
}


class StateTable:
    """Versions of (entity, id, ct, lt) below ``path``; every handled batch commits one.

    A batch that has been committed is known (``handled``): its writers came first, so there is
    nothing left to do. One that was cut off finds the state as it was. Any other batch, of this run
    or a new one, goes on from the last version. One query at a time may write.
    """

    def __init__(self, path: str, fan: int = 8, buckets: int = 64):
        self.path, self.fan, self.buckets = path.rstrip("/"), fan, buckets
        self.snapshots = Snapshots(path)

    def _bucket(self, entity: str = "entity") -> Column:
        return F.pmod(F.xxhash64(entity), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _parts(state: Manifest) -> dict:
        """``fresh``: runs that are not bucketed; ``buckets``: bucket -> [[level, run], ...], oldest first."""
        return {"fresh": list(state.parts.get("fresh", [])), "buckets": {b: list(r) for b, r in state.parts.get("buckets", {}).items()}}

    def handled(self, spark: SparkSession, batch: Batch) -> bool:
        return self.snapshots.newest(spark).holds(batch)

    def before(self, like: DataFrame, entities: DataFrame | None = None) -> DataFrame:
        """The state (entity, id, ct, lt); of the given entities (entity) only.

        Up to NAMED x SCANS of them are looked up by name: a scan for every NAMED reads the files of their
        buckets only, and of these the pages that may hold them. More of them are joined with the whole.
        """
        spark, state = like.sparkSession, self.snapshots.newest(like.sparkSession)
        parts = self._parts(state)
        if not parts["fresh"] and not parts["buckets"]:
            return spark.createDataFrame([], like.schema)
        if entities is None:
            rows = self._scan(like, [*parts["fresh"], *(run for runs in parts["buckets"].values() for _, run in runs)])
            return self._newest(rows)
        asked = entities.select("entity", self._bucket().alias("bucket"))
        listed = asked.limit(NAMED * SCANS + 1).collect()
        if len(listed) > NAMED * SCANS:
            rows = self._scan(like, [*parts["fresh"], *(run for runs in parts["buckets"].values() for _, run in runs)])
            return self._newest(rows.join(entities, "entity", "left_semi"))
        found, listed = None, sorted(listed, key=lambda row: row.bucket)
        for at in range(0, len(listed), NAMED):
            wanted = defaultdict(list)
            for row in listed[at: at + NAMED]:
                wanted[row.bucket].append(row.entity)
            runs = [run for bucket in wanted for _, run in parts["buckets"].get(str(bucket), [])]
            # a bucket's names are held against the pages of that bucket only
            terms = [self._named(bucket, names) for bucket, names in wanted.items()]
            while len(terms) > 1:
                terms = [reduce(or_, terms[i: i + 2]) for i in range(0, len(terms), 2)]
            rows = self._scan(like, [*parts["fresh"], *runs]).filter(terms[0])
            found = rows if found is None else found.union(rows)
        return spark.createDataFrame([], like.schema) if found is None else self._newest(found)

    def write(self, moved: DataFrame, batch: Batch) -> None:
        """Commit the entities that a batch has moved, then merge the runs that have become too many."""
        spark = moved.sparkSession
        state = self.snapshots.newest(spark)
        if state.holds(batch):
            return
        parts, run = self._parts(state), f"runs/{state.version + 1}"
        self._sorted(moved.withColumn("version", F.lit(state.version + 1).cast("bigint"))).write.mode("overwrite").options(
            **LAYOUT
        ).parquet(f"{self.path}/{run}")
        parts["fresh"].append(run)
        self._merge(moved, self.snapshots.commit(spark, state, parts, batch))

    def _merge(self, like: DataFrame, state: Manifest) -> None:
        """One step of merging, if one is due: the fresh runs, or the runs of one level in the buckets that have FAN."""
        parts, spark = self._parts(state), like.sparkSession
        like = like.select("entity", "id", "ct", "lt")
        if len(parts["fresh"]) >= self.fan:
            sources, level, due = parts["fresh"], 1, None
            parts["fresh"] = []
        else:
            level, due = self._due(parts["buckets"])
            if not due:
                return
            sources = [run for runs in due.values() for run in runs]
        target = f"runs/{state.version + 1}"
        rows = self._sorted(self._newest(self._scan(like, sources), "version")).withColumn("b", F.col("bucket"))
        rows.write.mode("overwrite").options(**LAYOUT).partitionBy("b").parquet(f"{self.path}/{target}")
        if due is None:
            made = [int(n.split("=")[1]) for n in folders.names(spark, f"{self.path}/{target}") if n.startswith("b=")]
        else:
            made = [int(b) for b in due]
            for b, runs in due.items():
                parts["buckets"][b] = [r for r in parts["buckets"][b] if r[1] not in runs]
        for bucket in made:
            runs = parts["buckets"].setdefault(str(bucket), [])
            runs.append([level, f"{target}/b={bucket}"])
        self._merge(like, self.snapshots.commit(spark, state, parts, gone=sources))

    def _due(self, buckets: dict) -> tuple[int, dict[str, list[str]]]:
        """The lowest level that is full somewhere, as (next level, bucket -> its runs there)."""
        full: dict[int, dict[str, list[str]]] = defaultdict(dict)
        for bucket, runs in buckets.items():
            by_level = defaultdict(list)
            for level, run in runs:
                by_level[level].append(run)
            for level, some in by_level.items():
                if len(some) >= self.fan:
                    full[level][bucket] = some
        return (min(full) + 1, full[min(full)]) if full else (0, {})

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """Rows as every run holds them: by bucket, then by entity."""
        return rows.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", "entity")

    def _scan(self, like: DataFrame, runs: list[str]) -> DataFrame:
        added = [T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())]
        schema = T.StructType([*like.schema.fields, *added])
        return like.sparkSession.read.schema(schema).parquet(*[f"{self.path}/{run}" for run in runs])

    @staticmethod
    def _named(bucket: int, names: list[str]) -> Column:
        """Whether a row is one of the names' in a bucket; one expression, as ``isin`` calls the JVM for every name."""
        texts = ", ".join(f"cast(X'{name.encode().hex()}' as string)" for name in names)
        return F.expr(f"bucket = {bucket} and entity in ({texts})")

    @staticmethod
    def _newest(rows: DataFrame, *more: str) -> DataFrame:
        """The row of each entity that the last version wrote."""
        newest = rows.groupBy("entity").agg(F.max(F.struct("version", "ct", "id", "lt")).alias("s"))
        return newest.select("entity", "s.id", "s.ct", "s.lt", *[f"s.{c}" for c in more])
