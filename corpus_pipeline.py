"""Documents to training tokens: five stages, each over all that the one before kept.

Every stage's rows are written as Parquet and read again as the next one's documents. All but the
last return the columns of their input. In all stages NULL and empty texts, NULL ids, sources and languages, repeated
rows, very long texts, extra columns and empty tables have the results that the called operators state;
none of them ends a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sightline import session
from sightline.llm import common, decontaminate, mixing, quality, simhash, tokenfiles

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the trusted texts of their language allow; odd rows as in ``quality.keep_good``."""
    with common.stage(session.prepare(spark), docs):
        return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; odd rows as in ``simhash.keep_one``."""
    with common.stage(session.prepare(spark), docs):
        return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; odd rows as in ``decontaminate.keep_clean``."""
    with common.stage(session.prepare(spark), docs):
        return decontaminate.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for; odd rows as in ``mixing.mixed``."""
    with common.stage(session.prepare(spark), docs):
        return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and where each document stands in them; odd rows as in ``tokenfiles.encoded``."""
    with common.stage(session.prepare(spark), docs):
        return tokenfiles.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]

#: SQL has no language model, no 64-bit fingerprints and no tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    session.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
