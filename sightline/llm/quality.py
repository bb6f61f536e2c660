"""Quality by the perplexity of an interpolated modified Kneser-Ney model.

The model predicts a text's next character from the two before it and is counted on trusted texts.
An interpolated model's log-probability is a sum over the grams of a text, each times its count:

    log p(c | ab) = log p1(c) + [log g(b) + boost(bc)] + [log g(ab) + boost(abc)]

where g is the backoff weight of a context and a boost is what a seen gram adds to its backed-off
probability (nothing if unseen). So a text's perplexity is a join of its gram counts with one table,
gram -> gain, that is cut into shards by a hash of the gram. Gram counts of many texts travel
together, packed per shard; a shard answers with one partial sum per text.

Thresholds are quantiles, per language, over trusted texts that the model has not counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

#: A gram is 21 bits per character. These are no characters: start, end, and heads of shorter grams.
BITS = 21
START, END, HEAD2, HEAD1 = 0x110000, 0x110001, 0x110002, 0x110003
#: Characters handled at once in a task; their grams take some 150 bytes each.
BLOCK = 500_000
#: Least number of model shards, and most grams in one.
SHARDS, SHARD_GRAMS = 8, 100_000
#: Rows to Python at once: each may carry a model shard (1.2 MB at most).
ROWS = 32
#: Trusted texts of this fold (crc32 of the id mod 4) set the thresholds, the others are counted.
HELD_OUT = 3
#: Texts above this quantile of trusted ones go, ``MARGIN`` times the quantile being allowed.
QUANTILE, MARGIN = 0.995, 1.05
#: Allowance for chance in short texts: the threshold is raised by exp(SLACK / sqrt(characters)).
SLACK = 2.5

PACKED = (
    "batch bigint, shard int, n_docs int, keys binary, sizes binary, docs binary, counts binary, "
    "lengths binary, ids array<string>, langs array<string>, digests array<string>"
)
#: What names a text of a block; strings, so that NULLs and large numbers survive.
NAMES = {"_id": "ids", "_lang": "langs", "_digest": "digests"}


def _pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers of ``width`` bytes, byte planes apart, compressed."""
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + zlib.compress(raw.T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(zlib.decompress(packed[1:]), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}").astype(np.int64)


def _width(values: np.ndarray) -> int:
    most = int(values.max(initial=0))
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and how often each stands."""
    if not len(ordered):
        return ordered, ordered
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.diff(np.concatenate([first, [len(ordered)]]))


class Block:
    """The grams of some texts: for each order (key, text number, count), by key and text."""

    def __init__(self, texts: list[str]):
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
        lengths = np.array([len(p) + 3 for p in points], dtype=np.int64)
        flat = np.empty(int(lengths.sum()), dtype=np.uint32)
        at = 0
        for p in points:
            flat[at : at + 2], flat[at + 2 : at + 2 + len(p)], flat[at + 2 + len(p)] = START, p, END
            at += len(p) + 3
        self.n = len(texts)
        self.symbols = np.flatnonzero(np.bincount(flat, minlength=1)).astype(np.int64)
        rank = np.zeros(int(flat.max(initial=0)) + 1, dtype=np.int64)
        rank[self.symbols] = np.arange(len(self.symbols))
        self.local = rank[flat]
        self.owner = np.repeat(np.arange(self.n, dtype=np.int64), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.third, self.second = place >= 2, place >= 1

    def _key(self, ranks: list[np.ndarray], head: int | None) -> np.ndarray:
        key = np.zeros(len(ranks[0]), dtype=np.int64)
        for r in ranks:
            key = key << BITS | self.symbols[r]
        return key if head is None else key | head << 2 * BITS

    def of_order(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = (self.second, self.second, self.third)[order - 1]
        size, at = len(self.symbols), np.flatnonzero(own)
        gram = np.zeros(len(at), dtype=np.int64)
        for back in range(order - 1, -1, -1):
            gram = gram * size + self.local[at - back]
        pair, counts = _runs(np.sort(gram * max(self.n, 1) + self.owner[at]))
        gram, doc = pair // max(self.n, 1), pair % max(self.n, 1)
        ranks = [gram // size**back % size for back in range(order - 1, -1, -1)]
        return self._key(ranks, {1: HEAD1, 2: HEAD2, 3: None}[order]), doc, counts


def _mix(keys: np.ndarray) -> np.ndarray:
    """The shard hash of grams; the same as ``_mixed`` of a column."""
    return (keys ^ keys >> 31) % 1_000_003


def _mixed(key: Column) -> Column:
    return key.bitwiseXOR(F.shiftright(key, 31)) % 1_000_003


def _blocks(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[tuple[list[str], list[list]]]:
    """(texts, their names) of about BLOCK characters at a time."""
    texts, named, held = [], [[] for _ in names], 0
    for batch in batches:
        for row in zip(batch["_text"], *[batch[c] for c in names]):
            texts.append(row[0])
            for values, value in zip(named, row[1:]):
                values.append(value)
            held += len(row[0])
            if held >= BLOCK or len(texts) >= 60_000:
                yield texts, named
                texts, named, held = [], [[] for _ in names], 0
    if texts:
        yield texts, named


def _trusted_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for texts, _ in _blocks(batches, []):
        key, _, count = Block(texts).of_order(3)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield pd.DataFrame({"key": key[first], "n": np.add.reduceat(count, first)})


def _packed_grams(shards: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for number, (texts, named) in enumerate(_blocks(batches, list(NAMES))):
            block = Block(texts)
            # in this order the keys ascend over all three
            key, doc, count = (np.concatenate(x) for x in zip(*[block.of_order(k) for k in (3, 2, 1)]))
            del block
            shard = _mix(key) % shards
            lengths = _pack(np.array([len(t) + 1 for t in texts]), 4)
            rows = []
            for s in range(shards):
                own = np.flatnonzero(shard == s)
                keys, sizes = _runs(key[own])
                gaps = doc[own].copy()
                gaps[1:] -= np.where(key[own][1:] == key[own][:-1], doc[own][:-1], 0)
                rows.append((
                    part << 32 | number, s, len(texts), _pack(np.diff(keys, prepend=0), 8),
                    _pack(sizes, _width(sizes)), _pack(gaps, _width(gaps)), _pack(count[own], _width(count[own])),
                    *((lengths, *named) if s == 0 else (None,) * 4),
                ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PACKED.split(", ")])
    return run


def _shard_blob(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("key")
    keys, gains = rows["key"].to_numpy("<i8").tobytes(), rows["gain"].to_numpy("<f4").tobytes()
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "model_keys": [keys], "gains": [gains]})


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partial sum for each text of a packed row."""
    for batch in batches:
        out = []
        for row in batch.itertuples():
            keys, sizes, count = np.cumsum(_unpack(row.keys)), _unpack(row.sizes), _unpack(row.counts)
            gap, start = _unpack(row.docs), np.cumsum(sizes) - sizes
            running = np.cumsum(gap)
            doc = running - np.repeat(running[start] - gap[start], sizes) if len(gap) else gap
            gain = np.zeros(len(keys))
            if row.model_keys is not None and len(keys):
                known, gains = np.frombuffer(row.model_keys, "<i8"), np.frombuffer(row.gains, "<f4")
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                gain = np.where(known[at] == keys, gains[at], 0.0)
            total = np.bincount(doc, np.repeat(gain, sizes) * count, minlength=row.n_docs)
            out.append((row.batch, total.astype("<f4").tobytes(), row.lengths, row.ids, row.langs, row.digests))
        yield pd.DataFrame(out, columns=["batch", "sums", "lengths", *NAMES.values()])


def _gathered(unknown: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                n = _unpack(row.lengths)
                log_p = sum(np.frombuffer(s, "<f4").astype(float) for s in row.parts) + unknown * n
                names = {c: list(getattr(row, many)) for c, many in NAMES.items()}
                yield pd.DataFrame(names | {"n_grams": n, "perplexity": np.exp(-log_p / n)})
    return run


def _level(counts: DataFrame, n: str, context: list[str]) -> tuple[DataFrame, DataFrame, dict]:
    """Counts with their discounts, and each context's total and backoff weight."""
    row = counts.agg(*[F.sum((F.col(n) == i).cast("bigint")).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = [float(row[f"n{i}"] or 0) for i in (1, 2, 3, 4)]
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        d = [min(max(x, 0.1), i + 0.95) for i, x in enumerate(found)]
    else:
        d = [0.5, 0.75, 0.9]
    cut = F.when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])
    counts = counts.withColumn("cut", cut)
    totals = counts.groupBy(*context).agg(F.sum(n).alias("total"), (F.sum("cut") / F.sum(n)).alias("back"))
    return counts, totals


def model(trusted: DataFrame) -> tuple[DataFrame, float]:
    """(key, gain) of every gram of the trusted texts (_id, _text), and an unknown character's log p."""
    with common.arrow_rows(trusted.sparkSession, ROWS):
        counted = trusted.mapInPandas(_trusted_grams, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        three = common.stored(counted, "quality-grams", ROWS)
    mask = (1 << BITS) - 1
    three = three.select(
        F.shiftright("key", 2 * BITS).alias("a"), F.shiftright("key", BITS).bitwiseAND(F.lit(mask)).alias("b"),
        F.col("key").bitwiseAND(F.lit(mask)).alias("c"), "n",
    )
    two = common.stored(three.groupBy("b", "c").agg(F.count("*").alias("n")), "quality-pairs")
    one = common.stored(two.groupBy("c").agg(F.count("*").alias("n")), "quality-singles")
    three, back3 = _level(three, "n", ["a", "b"])
    two, back2 = _level(two, "n", ["b"])
    one, back1 = _level(one, "n", [])
    top = back1.first()
    size = one.count()
    unknown = (top["back"] or 1.0) / (size + 1)
    p1 = one.select("c", ((F.col("n") - F.col("cut")) / F.lit(float(top["total"] or 1)) + unknown).alias("p1"))
    p2 = (
        two.join(back2, "b").join(p1, "c")
        .withColumn("low", F.col("back") * F.col("p1")).withColumn("p2", (F.col("n") - F.col("cut")) / F.col("total") + F.col("low"))
        .select("b", "c", "p2", F.log(F.col("p2") / F.col("low")).alias("boost"))
    )
    p2 = common.stored(p2, "quality-p2")
    p3 = (
        three.join(back3, ["a", "b"]).join(p2.select("b", "c", "p2"), ["b", "c"])
        .withColumn("low", F.col("back") * F.col("p2")).withColumn("p3", (F.col("n") - F.col("cut")) / F.col("total") + F.col("low"))
    )

    def key(x: Column, y: Column, z: Column) -> Column:
        return F.shiftleft(x, 2 * BITS).bitwiseOR(F.shiftleft(y, BITS)).bitwiseOR(z)

    def gain(*parts: Column) -> Column:
        return sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0))).alias("gain")

    head = [F.lit(h).cast("bigint") for h in (HEAD1, HEAD2)]
    zero = F.lit(0).cast("bigint")
    ones = p1.join(back2.select(F.col("b").alias("c"), "back"), "c", "full").select(
        key(head[0], zero, F.col("c")).alias("key"), gain(F.log(F.col("p1") / unknown), F.log("back")),
    )
    twos = p2.join(back3.select(F.col("a").alias("b"), F.col("b").alias("c"), "back"), ["b", "c"], "full").select(
        key(head[1], F.col("b"), F.col("c")).alias("key"), gain(F.col("boost"), F.log("back")),
    )
    threes = p3.select(key(F.col("a"), F.col("b"), F.col("c")).alias("key"), F.log(F.col("p3") / F.col("low")).alias("gain"))
    return common.stored(ones.union(twos).union(threes), "quality-model"), float(np.log(unknown))


def perplexities(texts: DataFrame, trusted: DataFrame) -> DataFrame:
    """(_id, _lang, _digest, n_grams, perplexity) of every text (_id, _lang, _digest: string, _text).

    ``trusted`` (_text) is what the model is counted on. Texts are whole and not NULL; the empty text has the
    perplexity of its end alone. NULL ids and languages stay NULL, repeated rows are judged row by row, and an
    empty table of texts gives an empty result; without trusted texts all characters are alike.
    """
    spark = texts.sparkSession
    gains, unknown = model(trusted)
    shards = max(SHARDS, gains.count() // SHARD_GRAMS + 1)
    copies = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    blobs = (
        gains.withColumn("shard", (_mixed(F.col("key")) % shards).cast("int")).groupBy("shard")
        .applyInPandas(_shard_blob, "shard int, model_keys binary, gains binary")
    )
    blobs = common.stored(blobs, "quality-shards").select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    packed = texts.mapInPandas(_packed_grams(shards), PACKED).withColumn(
        "copy", F.pmod(F.hash("batch"), F.lit(copies))
    )
    # always a shuffle: the model grows with the trusted texts, so its small beginnings are no guide
    joined = packed.join(blobs.hint("merge"), ["shard", "copy"], "left").drop("shard", "copy")
    answer = "batch bigint, sums binary, lengths binary, ids array<string>, langs array<string>, digests array<string>"
    sums = joined.mapInPandas(_sums, answer)
    whole = sums.groupBy("batch").agg(
        F.collect_list("sums").alias("parts"), *[F.max(c).alias(c) for c in ("lengths", *NAMES.values())]
    )
    named = whole.mapInPandas(
        _gathered(unknown), "_id string, _lang string, _digest string, n_grams bigint, perplexity double"
    )
    return common.stored(named, "quality-perplexity", ROWS)


def judge(
    docs: DataFrame, labels: DataFrame, text: str = "text", row_id: str = "doc_id", lang: str = "lang",
    quantile: float = QUANTILE, margin: float = MARGIN,
) -> DataFrame:
    """(``row_id``, ``lang``, n_grams, perplexity, threshold, kept), a row for each row of ``docs``.

    Trusted texts are those with a label (``row_id``, quality) of 1 and none of 0. Three of four are
    counted; the others set each language's threshold, ``margin`` times their ``quantile``, and
    more for short texts, whose perplexity varies by chance. However few they are, a language is
    judged by its own; one without any takes the quantile over all. A NULL language is one of its own. Empty and NULL texts have the perplexity of an immediate end and are
    rejected: there is nothing to learn from. NULL ids are never trusted, repeated ids are judged
    row by row. Without held-out trusted texts everything but the empty is kept. Texts are counted
    and judged whole.
    """
    whole = docs.select(
        F.col(row_id).cast("string").alias("_id"), F.col(lang).cast("string").alias("_lang"),
        F.xxhash64(common.whole(text)).cast("string").alias("_digest"), common.whole(text).alias("_text"),
    )
    trusted = (
        labels.select(F.col(row_id).cast("string").alias("_id"), "quality").filter("_id is not null and quality is not null")
        .groupBy("_id").agg(F.min("quality").alias("q")).filter("q = 1")
        .select("_id", (F.crc32("_id") % 4 == HELD_OUT).alias("_held"))
    )
    counted = whole.join(common.sized(trusted.filter("not _held").select("_id")), "_id").select("_text")
    measured = perplexities(whole, counted)
    held = measured.filter("n_grams > 1").join(trusted.filter("_held").select("_id"), "_id")
    limit = (F.percentile_approx("perplexity", quantile, 10_000) * margin).alias("threshold")
    over_all = held.agg(limit).first()["threshold"]
    own = held.groupBy("_lang").agg(limit).select(F.col("_lang").alias("_own"), "threshold")
    judged = measured.join(own, F.col("_lang").eqNullSafe(F.col("_own")), "left")
    threshold = F.coalesce("threshold", F.lit(over_all).cast("double"))
    threshold = threshold * F.exp(SLACK / F.sqrt("n_grams"))
    fine = (F.col("n_grams") > 1) & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return judged.select(
        F.col("_id").cast("bigint").alias(row_id), F.col("_lang").alias(lang), F.col("_digest").cast("bigint").alias("digest"),
        "n_grams", "perplexity", threshold.alias("threshold"), fine.alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", row_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps.

    NULL and empty texts, NULL ids and languages, very long texts and empty tables are as in ``judge``; equal
    rows (same id and text) go or stay together, and extra columns of any name are kept.
    """
    rejected = judge(docs, labels, text, row_id, lang).filter("not kept").select(row_id, "digest").distinct()
    return common.without(docs, rejected, row_id, text)


@query("op7_quality")
def op7_quality(spark, sf):
    return judge(common.table(spark, sf, "documents"), common.table(spark, sf, "labels")).drop("digest")
