"""Temperature mixing of sources.

A source's weight is its share of all tokens raised to an exponent between 0 (all alike) and 1 (as
they are), scaled to sum to one. The exponent is bisected: the largest one whose weights have the
target entropy, but never so small that a source would be repeated more often than allowed. Weights
times the token budget give each source's quota, and the quota is realised as whole passes over the
source and a last pass over part of it: the source's blocks in permuted order while they fit, then
the documents of the next block in permuted order while they fit.

A source is cut into BLOCKS blocks by a hash, so sums per block are what is ordered, not documents;
of the documents, only those of the one block per source that the quota ends in are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

#: Target entropy as part of the largest possible, most passes over a source, blocks per source.
ENTROPY, REPEATS, BLOCKS = 0.9, 2.0, 4096
SEED = 17
#: Exponents tried at once, and rounds of narrowing: the exponent is found to 16^-6.
TRIED, ROUNDS = 16, 6


def _place(row_id: str, text: str, seed: int) -> Column:
    """A row's place in its source's permutation."""
    return F.xxhash64(F.lit(seed), F.col(row_id).cast("string"), common.whole(text))


def exponent(totals: DataFrame, entropy: float, repeats: float, budget: float | None) -> tuple[float, float, float]:
    """(exponent, sum of T^exponent, budget) for sources with T = ``tokens`` > 0.

    Every round aggregates all sources for a row of exponents; only those sums reach the driver.
    Without a budget it is the least at which no source gets less than one pass.
    """
    t = F.col("tokens").cast("double")
    row = totals.agg(F.count("*").alias("n"), F.min(t).alias("least"), F.max(t).alias("most")).first()
    if not row["n"]:
        return 1.0, 1.0, budget or 0.0
    least, most, target = row["least"], row["most"], entropy * math.log(row["n"])

    def measured(alphas: list[float]) -> list[tuple[float, float, float]]:
        sums = [F.sum(F.pow(t, F.lit(a))) for a in alphas] + [F.sum(F.pow(t, F.lit(a)) * F.log(t)) for a in alphas]
        found = totals.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        out = []
        for i, a in enumerate(alphas):
            z = found[i]
            size = budget if budget is not None else most ** (1 - a) * z
            out.append((z, math.log(z) - a * found[i + len(alphas)] / z, size * least ** (a - 1) / z))
        return out

    def narrowed(good) -> float:
        """The largest exponent that is ``good``, where all below it are."""
        low, high = 0.0, 1.0
        if good(measured([1.0])[0]):
            return 1.0
        for _ in range(ROUNDS):
            alphas = [low + (high - low) * i / TRIED for i in range(1, TRIED)]
            fine = [a for a, m in zip(alphas, measured(alphas)) if good(m)]
            low, high = max(fine, default=low), min([a for a in alphas if a not in fine], default=high)
        return low

    for_entropy = narrowed(lambda m: m[1] >= target - 1e-12)
    # repetitions fall as the exponent rises: below this one they are too many
    for_repeats = narrowed(lambda m: m[2] > repeats + 1e-12)
    alpha = max(for_entropy, min(1.0, for_repeats + (TRIED**-ROUNDS if for_repeats > 0 else 0.0)))
    z = measured([alpha])[0][0]
    return alpha, z, budget if budget is not None else most ** (1 - alpha) * z


def plan(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", source: str = "source", entropy: float = ENTROPY,
    repeats: float = REPEATS, budget: float | None = None, blocks: int = BLOCKS, seed: int = SEED,
) -> DataFrame:
    """(``row_id``, ``source``, n_tokens, place, weight, copies): how often each row of ``docs`` is taken.

    Tokens are runs of characters other than white space. ``budget`` (tokens) defaults to the least
    with which every document is taken at least once. With a budget a source's documents are taken
    floor(quota / its tokens) times, and once more in permuted order while the rest of the quota
    lasts. Where entropy and repetition limit conflict, the limit holds; at the exponent 1 a budget
    may still ask for more passes than the limit, and then the quota is cut to it.

    A NULL source is one of its own. Sources without tokens weigh nothing and are taken once. Equal
    rows (same id and text) share a place and are taken alike. Ids may be NULL or repeated. An empty
    table gives an empty result.
    """
    rows = docs.select(
        F.col(row_id).cast("bigint").alias("_id"), F.col(source).cast("string").alias("_source"),
        F.regexp_count(common.whole(text), F.lit(r"\S+")).cast("bigint").alias("n_tokens"),
        _place(row_id, text, seed).alias("place"),
    ).withColumn("block", F.pmod("place", F.lit(blocks)).cast("int"))
    rows = common.stored(rows, "mixing-rows")
    sums = common.stored(
        rows.groupBy("_source", "block").agg(F.sum("n_tokens").alias("tokens")), "mixing-blocks"
    )
    totals = common.stored(sums.groupBy("_source").agg(F.sum("tokens").alias("tokens")), "mixing-sources")
    alpha, z, size = exponent(totals.filter("tokens > 0"), entropy, repeats, budget)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(alpha)) / z).otherwise(0.0)
    quota = F.least(weight * size, F.col("tokens") * F.lit(float(max(repeats, 1.0))))
    passes = F.floor(quota / F.col("tokens") + 1e-6)
    quotas = totals.select(
        F.col("_source").alias("_own"), weight.alias("weight"),
        F.when(F.col("tokens") > 0, passes).otherwise(1).alias("passes"),
        F.when(F.col("tokens") > 0, F.greatest(quota - passes * F.col("tokens"), F.lit(0.0))).otherwise(0.0).alias("rest"),
    )
    upto = W.partitionBy("_source").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    bounds = (
        sums.withColumn("upto", F.sum("tokens").over(upto))
        .join(quotas, F.col("_source").eqNullSafe(F.col("_own")))
        .select(
            F.col("_source").alias("_own"), F.col("block").alias("_block"), "weight", "passes",
            (F.col("upto") <= F.col("rest")).alias("fits"), (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"),
        )
    )
    bounds = common.stored(bounds, "mixing-bounds")
    known = rows.join(bounds, (F.col("block") == F.col("_block")) & F.col("_source").eqNullSafe(F.col("_own")))
    cut = ~F.col("fits") & (F.col("left") > 0)
    order = W.partitionBy("_source", "block").orderBy("place").rangeBetween(W.unboundedPreceding, 0)
    named = [F.col("_id").alias(row_id), F.col("_source").alias(source), "n_tokens", "place", "weight"]
    whole = known.filter(~cut).select(*named, (F.col("passes") + F.col("fits").cast("int")).cast("int").alias("copies"))
    part = known.filter(cut).withColumn("_sum", F.sum("n_tokens").over(order)).select(
        *named, (F.col("passes") + (F.col("_sum") <= F.col("left")).cast("int")).cast("int").alias("copies")
    )
    return whole.union(part)


def mixed(docs: DataFrame, text: str = "text", row_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as ``plan`` takes it.

    NULL sources, ids and texts, sources without tokens and empty tables are as in ``plan``; equal rows (same id
    and text) are each taken that often, and extra columns of any name are kept.
    """
    seed = options.get("seed", SEED)
    copies = plan(docs, text, row_id, source, **options).groupBy("place").agg(F.max("copies").alias("_copies"))
    copies = common.sized(common.stored(copies.withColumnRenamed("place", "_place"), "mixing-copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), _place(row_id, text, seed).alias("place"))
    taken = rows.join(copies, F.col("place") == F.col("_place")).filter("_copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")


@query("op6_temperature_mixing")
def op6_temperature_mixing(spark, sf):
    return plan(common.table(spark, sf, "documents")).drop("place")
