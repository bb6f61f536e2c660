"""Top-k most similar feature vectors within a category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline import schemas, session
from sightline.functions import keys, vectors


#: Query vectors up to this size are sent to every executor; more of them are shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024


def _sized(queries: DataFrame, max_bytes: int) -> DataFrame:
    """The queries, marked for broadcast if they are measured to be small enough.

    They are checkpointed first, so measuring them does not compute them twice. Without the mark
    Spark would shuffle the whole table before it could know how few queries there are.
    """
    session.shared_root(queries.sparkSession)
    ready = queries.checkpoint()
    # text of all columns: at least what the values take, but for long numbers
    weight = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in ready.columns), F.lit(0))
    measured = ready.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first().n
    return F.broadcast(ready) if measured <= max_bytes else ready


def _pairs(queries: DataFrame, table: DataFrame, category: list[str], max_bytes: int) -> DataFrame:
    """Each table row with the queries of its own category, joined where the row is read."""
    return table.join(_sized(queries, max_bytes), category)


def top_k(
    queries: DataFrame,
    table: DataFrame,
    category: list[str],
    query_id: str,
    query_vector: str,
    row_id: str,
    row_vector: str,
    k: int = schemas.TOP_K,
    distance=vectors.array_distance,
    digits: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, row_id, similarity, position): the ``k`` nearest rows of every query.

    Rows without a comparable vector are left out; ties go by row id. The limit is applied in
    every task before the shuffle, so a category of any size sends ``k`` rows per task and query.
    """
    score = distance(F.col(query_vector), F.col(row_vector))
    if digits is not None:
        score = F.round(score, digits)
    scored = _pairs(queries, table, category, broadcast_bytes).select(query_id, row_id, score.alias("similarity"))
    # Missing distances go last and are dropped after the limit: a filter before it would be
    # pushed below the projection and compute every distance a second time.
    order = [F.col("similarity").asc_nulls_last(), F.col(row_id)]
    rank = F.row_number().over(W.partitionBy(query_id).orderBy(*order))
    nearest = scored.withColumn("position", rank).filter(F.col("position") <= k)
    return nearest.filter(F.col("similarity").isNotNull())


def nearest_to_one(
    query: DataFrame,
    table: DataFrame,
    category: list[str],
    query_vector: str,
    row_id: str,
    row_vector: str,
    k: int = schemas.TOP_K,
    distance=vectors.array_distance,
    digits: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` nearest rows of a single query row, as one ordered limit."""
    score = distance(F.col(query_vector), F.col(row_vector))
    if digits is not None:
        score = F.round(score, digits)
    table = in_category_of(query, table, category)
    scored = _pairs(query, table, category, broadcast_bytes).select(row_id, score.alias("similarity"))
    nearest = scored.orderBy(F.col("similarity").asc_nulls_last(), row_id).limit(k)
    return nearest.filter(F.col("similarity").isNotNull())


def nearest_by_sql(
    spark: SparkSession, query: DataFrame, table: DataFrame, k: int = schemas.TOP_K
) -> DataFrame:
    """The same in SQL with the registered distance function.

    ``query`` has (category, feature), ``table`` has (id, category, feature).
    """
    name = vectors.register(spark)
    table = in_category_of(query, table, ["category"])
    query = _sized(query, BROADCAST_BYTES)
    return spark.sql(
        f"""
        select id, similarity from (
            select t.id, {name}(q.feature, t.feature) as similarity
            from {{table}} t join {{query}} q on t.category = q.category
            where t.feature != '' and t.feature != :missing
            order by similarity asc nulls last, id limit {int(k)})
        where similarity is not null
        """,
        args={"missing": schemas.NULL_FEATURE_TEXT},
        table=table,
        query=query,
    )


def in_category_of(query: DataFrame, table: DataFrame, category: list[str]) -> DataFrame:
    """The rows of the single query row's category, by its values, which a scan can be pruned with."""
    found = query.select(*category).first()
    for c in category:
        table = table.filter(F.col(c) == (found[c] if found else None))
    return table


def first_row(table: DataFrame, row_id: str) -> DataFrame:
    """The row with the least id, found without touching the other columns."""
    least = table.agg(F.min(row_id).alias("least")).first().least
    return table.filter(F.col(row_id) == least).limit(1)


def first_per_category(table: DataFrame, category: list[str], row_id: str, vector: str) -> DataFrame:
    """The earliest row of each category as its query: (category, query_id, query_vector).

    The ids are found without touching the vectors; only the rows that have them are fetched.
    """
    ids = table.groupBy(*category).agg(F.min(row_id).alias("query_id"))
    vectors_of = table.select(*category, F.col(row_id).alias("query_id"), F.col(vector).alias("query_vector"))
    found = vectors_of.join(ids, [*category, "query_id"])
    return found.groupBy(*category, "query_id").agg(F.max("query_vector").alias("query_vector"))


def parse_queries(lines: DataFrame, value: str = "value") -> DataFrame:
    """Query lines ``feature,model,brand`` to columns; the codes are NULL when not numbers."""
    fields = lines.select(*keys.split_fields(F.col(value), ["feature", "model", "brand"]))
    return fields.select(
        "feature",
        F.col("model").try_cast("int").alias("model_id"),
        F.col("brand").try_cast("int").alias("brand_id"),
    )


def category_filter(model: Column, brand: Column, model_id: int, brand_id: int) -> Column:
    return (model == model_id) & (brand == brand_id)
