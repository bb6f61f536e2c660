"""Token ids in compressed binary files that can be read at any place.

Texts are sorted by id over range partitions (shards), encoded, closed with an end id, and cut into
blocks of whole documents. A block is compressed by Re-Pair: frequent pairs of neighbouring symbols are
replaced by new symbols, again and again, until no pair stands ``LEAST`` times. A round replaces
pairs that cannot overlap each other, the most frequent first, and the next one looks only where a
new symbol or a pair that was left is. A block's rules, the length each rule expands to and the
remaining symbols are stored. Any range of ids is decoded from the symbols that cover it, found by
the running sum of expansion lengths.

The files are Parquet, one row per block: where it stands, its documents and their lengths, the
grammar. So they are written by Spark's commit protocol and read wherever Spark reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline import session
from sightline.llm import common
from sightline.llm.registry import query
from sightline.llm.tokens import VOCABULARY, definition_at, encoder

END = 0
#: Ids after which a block is closed, and blocks sent between the JVM and Python at once.
BLOCK, BLOCKS_AT_ONCE = 1 << 20, 4
#: Times a pair must stand in a block to be replaced; the bits of the hash by which rare pairs are passed over.
LEAST, SLOT_BITS = 16, 17

SCHEMA = (
    "shard int, block int, before bigint, n_tokens bigint, ids array<string>, lengths binary, "
    "base int, rules binary, expansions binary, symbols binary"
)


def _slots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A hash of SLOT_BITS bits of each pair."""
    mixed = x.astype(np.uint32) * np.uint32(0x9E3779B1) ^ y.astype(np.uint32) * np.uint32(0x85EBCA77)
    return (mixed >> np.uint32(32 - SLOT_BITS)).astype(np.intp)


def _packed(x: np.ndarray, y: np.ndarray, top: int) -> np.ndarray:
    """Each pair of symbols below ``top`` as one number, in 32 bits where they suffice."""
    if top <= 1 << 16:
        return x.astype(np.uint32) << np.uint32(16) | y.astype(np.uint32)
    return x.astype(np.uint64) << np.uint64(32) | y.astype(np.uint64)


def _unpacked(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = pairs.dtype.type(4 * pairs.itemsize)
    return (pairs >> half).astype(np.int32), (pairs & ((pairs.dtype.type(1) << half) - pairs.dtype.type(1))).astype(np.int32)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of a sorted array and how often each stands."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _apart(left: list[int], right: list[int], slots: list[int]) -> list[int]:
    """Numbers of pairs, taken in turn, of which no two can overlap and no two have a slot in common."""
    lefts, rights, taken, out = set(), set(), set(), []
    for k, (a, b, slot) in enumerate(zip(left, right, slots)):
        if a not in rights and b not in lefts and slot not in taken:
            lefts.add(a)
            rights.add(b)
            taken.add(slot)
            out.append(k)
    return out


def _looked_at(symbols: np.ndarray, old: int, top: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places where a pair can have become frequent or was left: a symbol from ``old`` on, or one of those pairs."""
    kinds = np.zeros(top, dtype=np.uint8)
    kinds[left] = 1
    kinds[right] |= 2
    kinds[old:] = 4
    # bits: 1 and 2 for the sides of a pair that was left, 4 for a new symbol
    kind = kinds[symbols]
    x, y = kind[:-1], kind[1:]
    return np.flatnonzero((x | y) & 4 | x & y >> 1 & 1)


class Grammar:
    """Symbols below ``base`` are ids; symbol base + r stands for the pair rules[r]."""

    def __init__(self, base: int, rules: np.ndarray, expansions: np.ndarray, symbols: np.ndarray):
        self.base, self.rules, self.expansions, self.symbols = base, rules, expansions, symbols

    @classmethod
    def of(cls, ids: np.ndarray, least: int = LEAST) -> Grammar:
        base = int(ids.max(initial=0)) + 1
        symbols, rules, lengths = ids.astype(np.int32), [], np.ones(0, dtype=np.int64)
        top, at = base, np.arange(len(symbols) - 1)
        while len(at):
            x, y = symbols[at], symbols[at + 1]
            slot = _slots(x, y)
            some = np.bincount(slot, minlength=1 << SLOT_BITS)[slot] >= least
            # of overlapping pairs of one symbol every other one counts, from the left
            twins = np.flatnonzero(some & (x == y))
            start = np.concatenate([[True], np.diff(at[twins]) != 1])[: len(twins)]
            since = np.arange(len(twins)) - np.flatnonzero(start)[np.cumsum(start) - 1]
            some[twins[since % 2 == 1]] = False
            some = np.flatnonzero(some)
            at, slot, pair = at[some], slot[some], _packed(x[some], y[some], top)
            kinds, counts = _runs(np.sort(pair))
            kinds = kinds[counts >= least][np.argsort(-counts[counts >= least], kind="stable")]
            if not len(kinds):
                break
            left, right = _unpacked(kinds)
            own = _slots(left, right)
            use = np.array(_apart(left.tolist(), right.tolist(), own.tolist()))
            # the slot of a pair has its number; other pairs of the slot are told by the pair itself
            wanted, number = np.zeros(1 << SLOT_BITS, dtype=pair.dtype), np.zeros(1 << SLOT_BITS, dtype=np.int32)
            wanted[own[use]], number[own[use]] = kinds[use], top + np.arange(len(use), dtype=np.int32)
            hit = np.flatnonzero((wanted[slot] == pair) & (number[slot] > 0))
            at = at[hit]
            symbols[at] = number[slot[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols = symbols[keep]
            made = np.stack([left[use], right[use]], axis=1)
            rules.append(made)
            lengths = np.concatenate([lengths, cls._length(made, base, lengths)])
            rest = np.ones(len(kinds), dtype=bool)
            rest[use] = False
            at = _looked_at(symbols, top, top + len(use), left[rest], right[rest])
            top += len(use)
        return cls(base, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int32), lengths, symbols)

    @staticmethod
    def _length(pairs: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
        known = np.concatenate([lengths, [1]])
        return known[np.where(pairs >= base, pairs - base, len(lengths))].sum(axis=1)

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expansions of all symbols one after the other, where each starts, how long it is."""
        sizes = np.concatenate([np.ones(self.base, dtype=np.int64), self.expansions])
        starts = np.cumsum(sizes) - sizes
        base, ids, made = self.base, np.arange(self.base, dtype=np.uint32).tobytes(), []
        for a, b in self.rules.tolist():
            first = ids[4 * a : 4 * a + 4] if a < base else made[a - base]
            made.append(first + (ids[4 * b : 4 * b + 4] if b < base else made[b - base]))
        return np.frombuffer(ids + b"".join(made), dtype=np.uint32), starts, sizes

    def decode(self, start: int = 0, n: int | None = None) -> np.ndarray:
        """``n`` ids from ``start`` on; only the symbols that cover them are expanded."""
        flat, starts, sizes = self._tables()
        own = sizes[self.symbols]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        stop = total if n is None else min(total, start + n)
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        symbols, own = self.symbols[first:last], own[first:last]
        out_starts = np.cumsum(own) - own
        out = flat[np.arange(int(own.sum())) + np.repeat(starts[symbols] - out_starts, own)]
        skip = start - int(ends[first] - own[0])
        return out[skip : skip + stop - start]

    def packed(self) -> tuple[int, bytes, bytes, bytes]:
        return (self.base, self.rules.astype("<i4").tobytes(), self.expansions.astype("<i8").tobytes(),
                self.symbols.astype("<u2" if self.base + len(self.rules) <= 1 << 16 else "<u4").tobytes())

    @classmethod
    def unpacked(cls, base: int, rules: bytes, expansions: bytes, symbols: bytes) -> Grammar:
        pairs = np.frombuffer(rules, "<i4").reshape(-1, 2)
        kind = "<u2" if base + len(pairs) <= 1 << 16 else "<u4"
        return cls(base, pairs, np.frombuffer(expansions, "<i8"), np.frombuffer(symbols, kind).astype(np.int32))


def _encoded(definition: str, block: int):
    end = np.array([END], dtype=np.uint32).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, shard = encoder(definition), TaskContext.get().partitionId()
        number, before, held, ids, parts, lengths = 0, 0, 0, [], [], []

        def closed() -> pd.DataFrame:
            tokens = np.frombuffer(b"".join(parts), dtype=np.uint32)
            row = (shard, number, before, len(tokens), ids, np.array(lengths, dtype="<u4").tobytes(), *Grammar.of(tokens).packed())
            return pd.DataFrame([row], columns=[c.split()[0] for c in SCHEMA.split(", ")])

        for batch in batches:
            for i, found in zip(batch["_id"], encode.each(batch["_text"])):
                ids.append(i)
                parts.append(found + end)
                lengths.append(len(found) // 4 + 1)
                held += lengths[-1]
                if held >= block:
                    yield closed()
                    number, before, held, ids, parts, lengths = number + 1, before + held, 0, [], [], []
        if ids:
            yield closed()
        encode.forget()
    return run


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            ids = Grammar.unpacked(row.base, row.rules, row.expansions, row.symbols).decode().astype("<u4")
            lengths = np.frombuffer(row.lengths, "<u4").astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            raw = memoryview(ids.tobytes())
            sums = [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist())]
            yield pd.DataFrame({
                "_id": list(row.ids), "shard": row.shard, "at": row.before + starts, "n_tokens": lengths,
                "ids_crc32": np.array(sums, dtype=np.int64),
            })


def write(docs: DataFrame, path: str, tokenizer: str, text: str = "text", row_id: str = "doc_id", block: int = BLOCK) -> None:
    """Encode every text, in ascending order of ``row_id``, and write the files to ``path``.

    NULL and empty texts are the end id alone. NULL ids come first; rows of one id are in the order of
    a hash of their texts. Texts are encoded whole; one longer than a block has a block of its own
    size. An empty table writes no blocks. Other columns do not matter.
    """
    rows = docs.select(F.col(row_id).cast("bigint").alias("_key"), common.whole(text).alias("_text"))
    ordered = rows.repartitionByRange("_key").sortWithinPartitions("_key", F.xxhash64("_text"))
    named = ordered.select(F.col("_key").cast("string").alias("_id"), "_text")
    with common.arrow_rows(docs.sparkSession, 256):
        named.mapInPandas(_encoded(definition_at(tokenizer), block), SCHEMA).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, row_id: str = "doc_id") -> DataFrame:
    """(``row_id``, start, n_tokens, ids_crc32) of every document in the files, decoded from them.

    ``start`` counts the ids of all documents before; ids_crc32 is that of the document's ids as
    little-endian unsigned 32-bit numbers.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # one row per shard, as many as there were partitions
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = common.stored(
        blocks.mapInPandas(_decoded, "_id string, shard int, at bigint, n_tokens bigint, ids_crc32 bigint"),
        "token-documents", BLOCKS_AT_ONCE,
    )
    return found.join(offsets, "shard").select(
        F.col("_id").cast("bigint").alias(row_id), (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Write the files to the shared folder with the standard vocabulary and read them back.

    A row for each row of ``docs``: NULL and empty texts are the end id alone, repeated rows are documents of their
    own, NULL ids come first, texts are encoded whole, other columns do not matter, no rows give none.
    """
    path = session.scratch_path(docs.sparkSession, "token-files")
    write(docs, path, public_tokenizers.path(VOCABULARY), text, row_id)
    return read(docs.sparkSession, path, row_id)


@query("op8_token_files")
def op8_token_files(spark, sf):
    return encoded(common.table(spark, sf, "documents"))
