"""Distinct counts over rolling days by sketches that merge.

Every batch adds one HyperLogLog sketch per day that it has rows of; a day's, a week's or a month's
distinct count is the union of its sketches. Rows of days that were sketched are not read again, and
a sketch is a few kilobytes however many rows it stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.sinks.snapshots import Snapshots
from sightline.streaming.run import Batch

#: 2^K counters in a sketch, and the relative error that it stays within (three standard errors).
K = 12
ERROR = 3 * 1.04 / 2 ** (K / 2)


class DaySketches:
    """(day, sketch, n_rows) below ``path``, a version per batch; a batch that is in it is not added again."""

    def __init__(self, path: str):
        self.path, self.snapshots = path.rstrip("/"), Snapshots(path)

    def add(self, rows: DataFrame, day: str, value: str, batch: Batch) -> None:
        """Sketch a batch's values per day; NULL values and rows without a day do not count."""
        spark, state = rows.sparkSession, self.snapshots.newest(rows.sparkSession)
        if state.holds(batch):
            return
        run = f"runs/{state.version + 1}"
        made = rows.filter(F.col(day).isNotNull()).groupBy(F.col(day).cast("int").alias("day")).agg(
            F.hll_sketch_agg(value, F.lit(K)).alias("sketch"), F.count("*").alias("n_rows")
        )
        made.write.mode("overwrite").parquet(f"{self.path}/{run}")
        self.snapshots.commit(spark, state, {"runs": [*state.parts.get("runs", []), run]}, batch)

    def read(self, spark: SparkSession) -> DataFrame:
        runs = self.snapshots.newest(spark).parts.get("runs", [])
        schema = "day int, sketch binary, n_rows bigint"
        return spark.read.schema(schema).parquet(*[f"{self.path}/{r}" for r in runs]) if runs else spark.createDataFrame([], schema)

    def rolling(self, spark: SparkSession, days: int) -> DataFrame:
        """(day, n_rows, n_distinct): of every sketched day and the ``days`` - 1 calendar days before it; an estimate."""
        stored = self.read(spark)
        date = F.to_date(F.col("day").cast("string"), "yyyyMMdd")
        later = F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_format(F.date_add(date, i), "yyyyMMdd").cast("int")))
        spread = stored.select(later.alias("_into"), "sketch", "n_rows")
        known = stored.select(F.col("day").alias("_into")).distinct()
        return spread.join(known, "_into", "left_semi").groupBy(F.col("_into").alias("day")).agg(
            F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")
        )


def exact_rolling(rows: DataFrame, day: str, value: str, days: int) -> DataFrame:
    """(day, n_exact): the same by counting, which reads every day's values ``days`` times over."""
    date = F.to_date(F.col(day).cast("string"), "yyyyMMdd")
    known = rows.select(F.col(day).cast("int").alias("_into")).distinct()
    each = rows.filter(F.col(day).isNotNull()).select(date.alias("_date"), F.col(value).alias("_value")).distinct()
    into = F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_format(F.date_add("_date", i), "yyyyMMdd").cast("int")))
    return each.select(into.alias("_into"), "_value").join(known, "_into", "left_semi").groupBy(F.col("_into").alias("day")).agg(
        F.count_distinct("_value").alias("n_exact")
    )
