"""SimHash near-duplicates through BK-trees.

Two fingerprints within ``radius`` bits agree on at least one of radius + 1 blocks of bits, so the
trees are sharded by (block, its value): fingerprints meet only where they can be neighbours. Within
a shard a BK-tree (children keyed by their Hamming distance to the parent) is searched for every
fingerprint, following only the edges whose distance is within the radius.

The trees of a corpus grow with it, so they are not broadcast whole: every fingerprint travels to
its radius + 1 shards instead, 16 bytes each. A shard larger than ``SHARD`` (many fingerprints that
share one block) is cut again over its remaining bits, by the same argument, so no tree is larger.
Copies share a fingerprint and enter the trees once.

Near copies (``near_copies``) are texts whose sets of five-word shingles have a Jaccard similarity of
0.8 or more. At that similarity fingerprints differ in ten bits on average, in more than any radius
that shards well, so the trees only propose what is close. MinHash bands tell which texts can have
another near copy (one is overlooked with probability (1 - 0.8^4)^40 < 1e-9), and these are joined
exactly by the rare shingles they share. A large group of edited copies meets in shingles that all of
them share: its members are first held against the ones with the fewest rare shingles, which most are
similar to. What is left meets pair by pair, but for pairs whose sets' parities differ in more bits
than similar sets have different shingles. Every proposed link is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import session
from sightline.llm import common
from sightline.llm.registry import query

WORDS, RADIUS, SEED, BITS = 3, 2, 42, 64
#: What makes one document go: shingles of this many words, and their least Jaccard similarity.
KEEP_WORDS, SIMILAR = 5, 0.8
#: SIMILAR = 4/5 in whole numbers: with sizes m and n, 9 common >= 4 (m + n).
PARTS = (4, 9)
#: Trees propose links at this width, the usual one for near copies (Manku et al. 2007).
KEEP_RADIUS = 3
#: MinHash bands, and minima in one.
BANDS, MINIMA = 40, 4
#: Most fingerprints in one tree.
SHARD = 4000
#: 64-bit numbers that a set's parities take, and rounds in which the sets of a bucket are held against one of them.
PARITIES, LEADERS = 8, 3


def shingles(text: str, words: int) -> np.ndarray:
    """64-bit hashes of all runs of ``words`` words, in the order of the text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # both of ASCII only
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined = memoryview(b" ".join(found))
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    width = min(words, len(found))
    digest, seed = xxhash.xxh64_intdigest, SEED
    pairs = zip(starts[: len(found) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    return np.array([digest(joined[s:e], seed) for s, e in pairs], dtype=np.uint64)


def fingerprint(text: str, words: int = WORDS) -> int:
    """64 bits; a bit is 1 if it is set in over half of the hashes of the text's shingles."""
    return _majority(shingles(text, words))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [_signed(fingerprint(t, words)) for t in batch["_text"]]
            yield batch[["_id", "digest"]].assign(fp=np.array(made, dtype=np.int64))
    return run


class BKTree:
    """Distinct 64-bit numbers; the children of a node are keyed by their distance to it."""

    def __init__(self):
        self.children: dict[int, dict[int, int]] = {}
        self.root: int | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = value
            self.children[value] = {}
            return
        node = self.root
        while (apart := (node ^ value).bit_count()) in self.children[node]:
            node = self.children[node][apart]
        if apart:
            self.children[node][apart] = value
            self.children[value] = {}

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [] if self.root is None else [self.root]
        while todo:
            node = todo.pop()
            apart = (node ^ value).bit_count()
            if apart <= radius:
                found.append(node)
            todo += [c for d, c in self.children[node].items() if apart - radius <= d <= apart + radius]
        return found


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the same values as all links within the radius do, one less than each group."""
    tree, leader, out = BKTree(), {}, []

    def top(v: int) -> int:
        while leader[v] != v:
            leader[v] = leader[leader[v]]
            v = leader[v]
        return v

    for value in values:
        leader[value] = value
        for other in tree.within(value, radius):
            a, b = top(value), top(other)
            if a != b:
                leader[max(a, b)] = min(a, b)
                out.append((value, other))
        tree.add(value)
    return out


def _links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (_signed(a), _signed(b))
                for values in batch["fps"] for a, b in forest([int(v) & (1 << 64) - 1 for v in values], radius)
            ]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    size = [len(bits) // parts + (i < len(bits) % parts) for i in range(parts)]
    return [bits[sum(size[:i]) : sum(size[: i + 1])] for i in range(parts)]


def _masked(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _shards(fps: DataFrame, radius: int, limit: int) -> Iterator[DataFrame]:
    """Rounds of (fps: array<bigint>) of 2 to ``limit`` fingerprints; later rounds cut what was larger."""
    blocks = [([], list(range(BITS)))]  # of bits that agree already, and the others
    rows = fps.select("fp", F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("value"))
    while True:
        cuts, parts = [], []
        for i, (agreed, rest) in enumerate(blocks):
            for piece in _cut(rest, radius + 1) if len(rest) > radius else []:
                left = [b for b in rest if b not in piece]
                parts.append(F.when(F.col("block") == i, F.struct(
                    F.lit(len(cuts)).alias("block"),
                    F.col("fp").bitwiseAND(F.lit(_masked(agreed + piece))).alias("value"),
                )))
                cuts.append((agreed + piece, left))
        keyed = rows.select("fp", F.explode(F.array_compact(F.array(*parts))).alias("x")).select("fp", "x.*")
        keyed = common.stored(keyed, "simhash-keys")
        sizes = common.stored(
            keyed.groupBy("block", "value").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-sizes"
        )
        sized = keyed.join(sizes, ["block", "value"])
        last = any(len(left) <= radius for _, left in cuts)
        small = sized if last else sized.filter(F.col("n") <= limit)
        yield small.groupBy("block", "value").agg(F.collect_list("fp").alias("fps")).select("fps")
        if last or sizes.filter(F.col("n") > limit).isEmpty():
            return
        rows, blocks = sized.filter(F.col("n") > limit).select("fp", "block", "value"), cuts


def near_duplicates(
    docs: DataFrame, text: str = "text", row_id: str = "doc_id", words: int = WORDS, radius: int = RADIUS,
    limit: int = SHARD,
) -> DataFrame:
    """(``row_id``, fingerprint, component_id) for each row; ``row_id`` is a bigint.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest id that
    can be reached, the row's own included. Texts with fewer words than a shingle are one shingle;
    empty and NULL texts have the fingerprint 0 and link like any other. Repeated ids are rows of
    their own with the same component if their texts link. Rows with NULL ids link like
    others; a component in which all ids are NULL has the id NULL. Whole texts are hashed; an empty table gives an empty result.
    """
    found = classes(docs, text, row_id, words, radius, limit)
    return found.select(
        F.col("doc_id").alias(row_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def classes(docs: DataFrame, text: str, row_id: str, words: int = WORDS, radius: int = RADIUS, limit: int = SHARD) -> DataFrame:
    """(doc_id, digest, fp, component_id) for each row; ``digest`` is xxhash64 of the text."""
    whole = docs.select(
        F.col(row_id).cast("string").alias("_id"), F.xxhash64(common.whole(text)).alias("digest"), common.whole(text).alias("_text")
    )
    prints = whole.mapInPandas(_fingerprints(words), "_id string, digest bigint, fp bigint").select(
        F.col("_id").cast("bigint").alias("doc_id"), "digest", "fp"
    )
    prints = common.stored(prints, "simhash-fingerprints")
    first = common.stored(prints.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least")), "simhash-first")
    links = []
    for fps in _shards(first.select(F.col("node").alias("fp")), radius, limit):
        links.append(common.stored(fps.mapInPandas(_links(radius), "a bigint, b bigint"), "simhash-links", 64))
    pairs = links[0]
    for more in links[1:]:
        pairs = pairs.union(more)
    found = common.components(pairs, "simhash-edges")
    named = common.smallest_ids(first, found, "simhash-components").withColumnRenamed("node", "fp")
    return prints.join(common.stored(named, "simhash-classes"), "fp", "left").select("doc_id", "digest", "fp", "component_id")


def bands(distinct: np.ndarray) -> np.ndarray:
    """A key for each band of MinHash minima of a set of hashes; of no hashes, no keys."""
    if not len(distinct):
        return np.empty(0, dtype=np.int64)
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    shift = rng.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64)
    least = np.full(BANDS * MINIMA, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(distinct), 2048):
        seen = factor[:, None] * distinct[None, at : at + 2048] + shift[:, None]
        np.minimum(least, seen.min(axis=1), out=least)
    rows = least.reshape(BANDS, MINIMA)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], dtype=np.uint64).view(np.int64)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["_text"]:
            hashes = shingles(text, KEEP_WORDS)
            distinct = np.unique(hashes)
            # 128 bits: among 10^10 texts no two of different sets share them
            whole = xxhash.xxh3_128_intdigest(distinct.tobytes(), SEED)
            rows.append((_signed(whole >> 64), _signed(whole & (1 << 64) - 1), _signed(_majority(hashes)), bands(distinct)))
        made = pd.DataFrame(rows, columns=["s1", "s2", "fp", "keys"])
        yield pd.concat([batch[["_id", "digest"]].reset_index(drop=True), made], axis=1)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [np.unique(shingles(t, KEEP_WORDS)) for t in batch["_text"]]
        made = pd.DataFrame({"node": batch["node"].to_numpy(), "s": [s.view(np.int64) for s in found]})
        yield made.assign(**dict(zip(PARITY, np.array([parities(s) for s in found]).reshape(-1, PARITIES).T)))


PARITY = [f"p{k}" for k in range(PARITIES)]


def parities(distinct: np.ndarray) -> np.ndarray:
    """Bits that say of which of 64 * PARITIES kinds a set of hashes has an odd number.

    Those of two sets differ in at most as many bits as the sets have shingles that are not common.
    """
    odd = np.bincount((distinct % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_be_similar(x: str, y: str) -> Column:
    """Whether the parities of two sets allow them to be SIMILAR.

    With m and n shingles and o in common, 9 o >= 4 (m + n) leaves m + n - 2 o <= (m + n) / 9 that are not common.
    """
    apart = reduce(add, [F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITY])
    return PARTS[1] * apart <= F.col(f"{x}.m") + F.col(f"{y}.m")


def _could_link(x: str, y: str) -> Column:
    """Whether sets whose first common shingle stands at these places can be SIMILAR; x is no smaller than y.

    With sizes m and n and o shingles in common, o / (m + n - o) >= 4/5 means 9 o >= 4 (m + n), and o
    is at most what either set has from that place on.
    """
    most = F.least(F.col(f"{x}.m") - F.col(f"{x}.i"), F.col(f"{y}.m") - F.col(f"{y}.i"))
    larger = (F.col(f"{x}.m") > F.col(f"{y}.m")) | ((F.col(f"{x}.m") == F.col(f"{y}.m")) & (F.col(f"{x}.node") > F.col(f"{y}.node")))
    return larger & F.col(f"{y}.first") & (PARTS[1] * most >= PARTS[0] * (F.col(f"{x}.m") + F.col(f"{y}.m")))


def prefixes(sets: DataFrame) -> DataFrame:
    """(token, node, m, i, first, *PARITY): the shingles by which a set (node, s, *PARITY) meets all that are SIMILAR to it.

    A set's shingles are ordered by the number of sets that have them, the rarest first. Sets with a
    similarity of 4/5 have a shingle in common among the first m - ceil(4 m / 5) + 1 of the larger one and
    the first n - ceil(8 n / 9) + 1 (``first``) of the smaller one: beyond these places too few are left.
    Shingles of one set only take up places and give no rows, so what many texts share comes last
    and only meets where there is little else.
    """
    tokens = sets.select("node", F.explode("s").alias("token"))
    several = common.stored(tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-shared")
    own = tokens.join(several, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("known"))
    m, c = F.col("m"), F.size("known")
    reach = m - F.ceil(m * PARTS[0] / 5) + 1 - (m - c)
    placed = own.join(sets.select("node", F.size("s").cast("bigint").alias("m"), *PARITY), "node").filter(reach > 0)
    rows = placed.select("node", "m", *PARITY, (m - c).alias("alone"), F.posexplode(F.slice("known", F.lit(1), reach.cast("int"))).alias("at", "x"))
    i = (F.col("alone") + F.col("at")).cast("bigint")
    return rows.select(
        F.col("x.token").alias("token"), "node", "m", i.alias("i"), (i < m - F.ceil(m * 8 / PARTS[1]) + 1).alias("first"), *PARITY
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have a Jaccard similarity of SIMILAR or more."""
    sets = sets.select("node", "s")
    both = (
        pairs.join(sets.withColumnsRenamed({"node": "a", "s": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "s": "y"}), "b")
    )
    shared = F.size(F.array_intersect("x", "y"))
    return common.stored(both.filter(PARTS[1] * shared >= PARTS[0] * (F.size("x") + F.size("y"))).select("a", "b"), "simhash-similar")


def _placed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` (node) with the component of each node by the links found so far."""
    joined = common.stored(common.components(links, "simhash-edges"), "simhash-joined")
    return rows.drop("component").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _still_apart(rows: DataFrame) -> DataFrame:
    """The rows of tokens whose sets are of several components."""
    apart = rows.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return common.stored(rows.join(apart.select("token"), "token"), "simhash-open")


def _with_main(rows: DataFrame) -> DataFrame:
    """``rows`` with ``main``: whether a set is of the component that most sets of its bucket are of."""
    sizes = rows.groupBy("token", "component").agg(F.count("*").alias("n"))
    most = sizes.groupBy("token").agg(F.max(F.struct("n", "component")).alias("x")).select("token", F.col("x.component").alias("_most"))
    return rows.join(most, "token").withColumn("main", F.col("component") == F.col("_most")).drop("_most")


def links(sets: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) that join the same sets (node, s, *PARITY) as all pairs of SIMILAR sets do.

    ``known`` are pairs proposed by other means, verified first. In every bucket of sets that share
    a prefix shingle come next the links to the set with the fewest rare shingles, which the edited copies
    of a text are most likely to be similar to, so they cost a check or two each; then, LEADERS - 1 times, the
    links to the one with the fewest among those outside the bucket's main component. Then come all pairs
    that can be SIMILAR by their sizes, places and parities and that the links so far have not joined; the sets of
    a bucket's main component meet only the others there, not each other.
    """
    found = _verified(known.filter("a <> b").selectExpr("least(a, b) a", "greatest(a, b) b").distinct(), sets)
    rows = common.stored(_placed(prefixes(sets), found), "simhash-prefixes")
    for turn in range(LEADERS):
        rows = _still_apart(rows)
        led = rows if turn == 0 else _with_main(rows).filter(~F.col("main"))
        row, rare = F.struct("node", "m", "i", "first", "component", *PARITY), F.struct(F.col("i") / F.col("m"), "node")
        tops = led.groupBy("token").agg(F.min_by(row, rare).alias("t")).select("token", "t.*")
        x, y = rows.alias("x"), tops.alias("y")
        could = (F.col("x.component") != F.col("y.component")) & _may_be_similar("x", "y") & (_could_link("x", "y") | _could_link("y", "x"))
        pairs = x.join(y, "token").filter(could).selectExpr("least(x.node, y.node) a", "greatest(x.node, y.node) b").distinct()
        found = found.union(_verified(common.stored(pairs, "simhash-stars"), sets))
        rows = common.stored(_placed(rows, found), "simhash-prefixes")
    rows = common.stored(_with_main(_still_apart(rows)), "simhash-prefixes")
    x, y = rows.filter(~F.col("main")).alias("x"), rows.alias("y")
    could = (
        (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component"))
        & (F.col("y.main") | (F.col("x.node") > F.col("y.node"))) & _may_be_similar("x", "y") & (_could_link("x", "y") | _could_link("y", "x"))
    )
    pairs = x.join(y, could).selectExpr("least(x.node, y.node) a", "greatest(x.node, y.node) b").distinct()
    return found.union(_verified(common.stored(pairs, "simhash-rest"), sets))


def near_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest, component_id) for each row; ``digest`` is xxhash64 of the text.

    Rows link if their sets of KEEP_WORDS-word shingles are equal or have a Jaccard similarity of
    SIMILAR or more. BK-trees over the sets' fingerprints propose links first. A set can only be
    similar to another one if it has a MinHash band in common with one; those that have are joined
    exactly (``links``). Texts with fewer words than a shingle are one shingle; NULL, empty and blank texts
    have no shingle and are all one class. Repeated rows link. Rows with a NULL id link like others; a
    component in which all ids are NULL has the id NULL. Texts of any length are taken whole, an empty
    table gives an empty result, columns besides the two are not read.
    """
    whole = docs.select(
        F.col(row_id).cast("string").alias("_id"), F.xxhash64(common.whole(text)).alias("digest"), common.whole(text).alias("_text")
    )
    made = whole.mapInPandas(_sketches, "_id string, digest bigint, s1 bigint, s2 bigint, fp bigint, keys array<bigint>")
    sketches = common.stored(made.withColumn("_id", F.col("_id").cast("bigint")).withColumnRenamed("_id", "doc_id"), "simhash-sketches")
    with session.noting() as spent:
        least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest"))
        first = sketches.groupBy("s1", "s2").agg(least.alias("x"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
        first = common.stored(
            first.select("s1", "s2", F.col("x.doc_id").alias("least"), F.col("x.digest").alias("digest"), "fp", "keys")
            .withColumn("node", F.monotonically_increasing_id()), "simhash-first",
        )
        keyed = first.select(F.explode("keys").alias("key"), "node")
        several = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
        banded = keyed.join(several.select("key"), "key").select("node").distinct()
        trees = common.stored(first.groupBy("fp").agg(F.min("node").alias("top")), "simhash-tops")
        close = None
        for fps in _shards(trees.select("fp"), KEEP_RADIUS, SHARD):
            some = common.stored(fps.mapInPandas(_links(KEEP_RADIUS), "a bigint, b bigint"), "simhash-links", 64)
            close = some if close is None else close.union(some)
        x, y = (trees.select(F.col("fp").alias(c), F.col("top").alias(n)) for c, n in (("a", "x"), ("b", "y")))
        known = close.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        known = common.stored(known.union(first.join(trees, "fp").filter("node <> top").select("top", "node")), "simhash-known")
        needed = banded.union(known.selectExpr("explode(array(a, b)) node")).distinct()
        needed = common.stored(needed.join(first.select("node", "least", "digest"), "node").withColumnRenamed("digest", "_digest"), "simhash-needed")
        chosen = F.col("_id").cast("bigint").eqNullSafe(F.col("least")) & (F.col("digest") == F.col("_digest"))
        texts = whole.join(common.sized(needed), chosen).select("node", "_text")
        kinds = ", ".join(["node bigint, s array<bigint>", *(f"{p} bigint" for p in PARITY)])
        sets = texts.mapInPandas(_sets, kinds).groupBy("node").agg(*[F.first(c).alias(c) for c in ("s", *PARITY)])
        sets = common.stored(sets, "simhash-sets", 64)
        found = common.components(links(sets, known), "simhash-edges")
        named = common.smallest_ids(first.select("node", "least"), found, "simhash-components")
        named = first.select("node", "s1", "s2").join(named, "node").select("s1", "s2", "component_id")
        named = common.kept(named, "simhash-classes", spent)
    return sketches.join(named, ["s1", "s2"]).select("doc_id", "digest", "component_id")


def keep_one(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their near copies'.

    Of rows with the same id and text one stays. Rows with a NULL id stay if no id of their
    component is known, else they go. NULL, empty and blank texts are one class, of which one row stays. Texts
    of any length are taken whole, extra columns of any name are kept, an empty table gives an empty result.
    """
    found = common.stored(near_copies(docs, text, row_id).withColumnRenamed("doc_id", row_id), "simhash-rows")
    own = F.coalesce(F.col(row_id) == F.col("component_id"), F.col("component_id").isNull())
    left = common.without(docs, found.filter(~own).select(row_id, "digest").distinct(), row_id, text)
    repeated = found.filter(own).groupBy(row_id, "digest").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    repeated = common.stored(repeated, "simhash-repeated")
    if repeated.isEmpty():
        return left
    rows = left.select(
        F.struct(*left.columns).alias("row"), F.col(row_id).alias("id"), F.xxhash64(common.whole(text)).alias("digest")
    )
    again = repeated.select(F.col(row_id).alias("again"), F.col("digest").alias("same"))
    of_those = F.col("id").eqNullSafe(F.col("again")) & (F.col("digest") == F.col("same"))
    one = rows.join(again, of_those, "left_semi").dropDuplicates(["id", "digest"])
    return rows.join(again, of_those, "left_anti").union(one).select("row.*")


@query("op3_simhash")
def op3_simhash(spark, sf):
    return near_duplicates(common.table(spark, sf, "documents"))
