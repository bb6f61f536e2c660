"""Rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON object in ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def publish_files(df: DataFrame, path: str) -> None:
    as_json(df).write.mode("append").text(path)


def publish_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Send to a Kafka topic; the job ends after the brokers have taken every row."""
    (
        as_json(df).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
