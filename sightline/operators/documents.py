"""JSON documents by id: monthly and fixed indexes, patches, and term / range search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_documents(
    rows: DataFrame, doc_id: str, index: Column, version: Column, fields: list[str]
) -> DataFrame:
    """(index_name, doc_id, version, body); the body has ``fields`` without those that are NULL."""
    return rows.select(
        index.alias("index_name"),
        F.col(doc_id).cast("string").alias("doc_id"),
        version.cast("bigint").alias("version"),
        F.to_json(F.struct(*fields)).alias("body"),
    )


def upsert(documents: DataFrame) -> DataFrame:
    """One document per (index, id): the newest version, the greater body on a tie.

    Copies are reduced before the shuffle, so a document sent very often costs one row per task.
    """
    return (
        documents.groupBy("index_name", "doc_id")
        .agg(F.max(F.struct("version", "body")).alias("_d"))
        .select("index_name", "doc_id", "_d.version", "_d.body")
    )


def patch(base: DataFrame, patches: DataFrame, key: str) -> DataFrame:
    """Merge patch by id: a patch field that is not NULL replaces the document's field.

    ``patches`` holds one row per id (see ``latest_patch``).
    """
    fields = [c for c in patches.columns if c != key]
    side = patches.select(key, *[F.col(c).alias(f"_p_{c}") for c in fields])
    joined = base.join(side, key, "left")
    return joined.select(
        *[F.coalesce(f"_p_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns]
    )


def latest_patch(patches: DataFrame, key: str, version: list[str]) -> DataFrame:
    """The newest patch per id."""
    fields = [c for c in patches.columns if c not in (key, *version)]
    newest = patches.groupBy(key).agg(F.max(F.struct(*version, *fields)).alias("_p"))
    return newest.select(key, *[F.col(f"_p.{f}").alias(f) for f in fields])


def search(
    docs: DataFrame, term: Column, post_filter: Column, sort: list[str], size: int
) -> DataFrame:
    """The first ``size`` hits of a term query after the post-filter, ascending by ``sort``."""
    return docs.filter(term & post_filter).orderBy(*sort).limit(size)


def hit_counts(docs: DataFrame, term: Column, post_filter: Column) -> DataFrame:
    """One row: hits of the term query, and how many of them pass the post-filter."""
    return docs.filter(term).agg(
        F.count("*").alias("total_hits"), F.count_if(post_filter).alias("filtered_hits")
    )
