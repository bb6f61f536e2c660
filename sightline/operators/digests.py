"""Reconciliation that narrows down.

A stored table keeps, for every part (a day, say) and hash bucket, the number of its keys and a 128-bit
digest of them that does not depend on their order or on copies. Two tables are compared by these small
tables first; rows are read only from the buckets in which they differ. Buckets are folders and rows are
in the order of their parts within, so there are as many files as there is data for, however many parts.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.operators import reconcile

#: Differing buckets that are named to the scans; more of them are joined.
NAMED = 10_000


def digests(rows: DataFrame, key: str, part: str, bucket: str = "bucket") -> DataFrame:
    """(part, bucket, n_keys, d1, d2) of the different keys; rows without a key do not count."""
    keys = rows.filter(F.col(key).isNotNull()).select(part, bucket, key).distinct()
    halves = [F.bit_xor(F.xxhash64(F.lit(seed), key)).alias(f"d{seed}") for seed in (1, 2)]
    return keys.groupBy(part, bucket).agg(F.count("*").alias("n_keys"), *halves)


def store(rows: DataFrame, path: str, key: str, part: str, buckets: int = 64) -> None:
    """Write a table in parts and buckets, and its digests from what was written."""
    path = path.rstrip("/")
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    # the rows of a large part are dealt by their key and contents
    dealt = placed.repartitionByRange("bucket", part, key, F.xxhash64(*rows.columns))
    dealt.sortWithinPartitions("bucket", part).write.partitionBy("bucket").parquet(f"{path}/rows")
    digests(read(rows.sparkSession, path, placed), key, part).write.parquet(f"{path}/digests")


def read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{path.rstrip('/')}/rows")


def differing(spark: SparkSession, one: str, other: str, part: str) -> DataFrame:
    """(part, bucket) in which the keys of two stored tables differ, by their digests alone."""
    a, b = (spark.read.parquet(f"{p.rstrip('/')}/digests") for p in (one, other))
    same = a[part].eqNullSafe(b[part]) & (a["bucket"] == b["bucket"])
    equal = (a["n_keys"] == b["n_keys"]) & (a["d1"] == b["d1"]) & (a["d2"] == b["d2"])
    return a.join(b, same, "full_outer").filter(~F.coalesce(equal, F.lit(False))).select(
        F.coalesce(a[part], b[part]).alias(part), F.coalesce(a["bucket"], b["bucket"]).alias("bucket")
    )


def within(rows: DataFrame, apart: DataFrame, part: str) -> DataFrame:
    """The rows of the given (part, bucket), which are named to the scan."""
    named = apart.limit(NAMED + 1).collect()
    if not named:
        return rows.filter(F.lit(False))
    if len(named) > NAMED:
        side = apart.withColumnsRenamed({part: "_part", "bucket": "_bucket"})
        return rows.join(side, rows[part].eqNullSafe(side["_part"]) & (rows["bucket"] == side["_bucket"]), "left_semi")
    by_bucket = defaultdict(list)
    for row in named:
        by_bucket[row["bucket"]].append(row[part])
    terms = [(F.col("bucket") == b) & _one_of(part, parts) for b, parts in by_bucket.items()]
    # the scan passes over folders by the one, over row groups and pages by the other
    found = F.col("bucket").isin(list(by_bucket)) & _one_of(part, sorted({row[part] for row in named}, key=lambda p: (p is None, p)))
    return rows.filter(found).filter(reduce(or_, terms))


def _one_of(part: str, values: list) -> Column:
    known = F.col(part).isin([v for v in values if v is not None])
    return known | F.col(part).isNull() if None in values else known


def missing(primary: DataFrame, shadow: DataFrame, one: str, other: str, key: str, part: str) -> DataFrame:
    """``reconcile.missing`` of two stored tables: the keys that one of them lacks, with their counts.

    ``primary`` and ``shadow`` are ``read`` from ``one`` and ``other``.
    """
    apart = differing(primary.sparkSession, one, other, part).persist()
    try:
        return reconcile.missing(within(primary, apart, part), within(shadow, apart, part), key)
    finally:
        apart.unpersist()
