"""Prefix trie of conversations, rolled up by depth bands.

Turns become digests, and the key of a conversation's first d turns is the exclusive-or of the
digests of (place, turn): running totals that a long conversation can compute in pieces. Rows of one
key are a node, so a trie over any number of conversations is one aggregation, and its parent's key is
known from the same row.

Subtree sums never walk the depth. The trie is cut into bands of BAND depths:

* within a band a node hands its value to its ancestors there, BAND at most;
* a band's totals belong to its root, and the roots of all bands make a trie BAND times less deep,
  which is rolled up in the same way;
* the totals of its nodes, now complete, are handed to the BAND ancestors in the band above.

So there are log(depth) / log(BAND) rounds, and no node is copied more than 2 BAND times in each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import ORACLES, query
from sightline.operators import lists

#: Depths in a band; turns whose running totals are formed by one task; ids hashed as one piece.
BAND, PIECE, IDS = 16, 4096, 1024
#: A conversation takes up to HEADS - 1 turns from the first of its FAMILY.
FAMILY, HEADS = 5, 9
KEY = "struct<k1:bigint,k2:bigint>"


def _half(digest: Column, at: int) -> Column:
    """16 hex digits as a signed 64-bit integer."""
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint")


def turn_rows(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, digest, bytes): turns numbered from 0 in their order, without their texts."""
    who, what = common.whole(F.col(role).cast("string")), common.whole(F.col(text).cast("string"))
    rows = turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), who.alias("role"),
        F.sha2(F.concat_ws(":", F.octet_length(who), who, what), 256).alias("digest"),
        F.octet_length(what).cast("bigint").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    numbered = lists.with_positions(rows, "conv", order, "place")
    return common.stored(numbered.select("conv", F.col("place").cast("bigint").alias("place"), "digest", "bytes"), "trie-turns")


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv, length, depth, digest, bytes): the first h turns of the family's first, then the own after h.

    Every conversation has a row of depth 0 besides its turns. h = crc32(conv) mod HEADS.
    """
    own = rows.groupBy("conv").agg(F.max("place").alias("last"))
    heads = common.stored(rows.filter(F.col("place") < HEADS - 1), "trie-heads")
    head_count = heads.groupBy(F.col("conv").alias("base")).agg(F.count("*").alias("lent"))
    known = own.select(
        "conv", "last", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
        (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h"),
    ).join(head_count, "base", "left")
    known = known.withColumn("lent", F.least(F.col("h"), F.coalesce("lent", F.lit(0)))).withColumn(
        "length", F.col("lent") + F.greatest(F.col("last") + 1 - F.col("h"), F.lit(0))
    )
    known = common.stored(known, "trie-conversations")
    lent = known.join(heads.withColumnRenamed("conv", "base"), "base").filter("place < h").select(
        "conv", "length", (F.col("place") + 1).alias("depth"), "digest", "bytes"
    )
    # a conversation's own rows may be many: adaptive execution splits them in this join
    kept = rows.join(known.select("conv", "h", "lent", "length"), "conv").filter("place >= h").select(
        "conv", "length", (F.col("lent") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "bytes"
    )
    roots = known.select(
        "conv", "length", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("digest"),
        F.lit(0).cast("bigint").alias("bytes"),
    )
    return lent.union(kept).union(roots)


def keyed(sequences: DataFrame, piece: int) -> DataFrame:
    """(conv, length, depth, bytes, key, parent): keys of all prefixes.

    Running totals are formed within pieces of a conversation, and the pieces' own totals, one row
    for each, are carried on, so a conversation of any length is spread over many tasks.
    """
    salted = F.sha2(F.concat_ws(":", F.col("depth"), "digest"), 256)
    rows = common.barrier(sequences, salted=F.when(F.col("depth") > 0, salted)).select(
        "conv", "length", "depth", "bytes", F.floor(F.col("depth") / piece).alias("piece"),
        F.coalesce(_half(F.col("salted"), 1), F.lit(0)).alias("d1"), F.coalesce(_half(F.col("salted"), 17), F.lit(0)).alias("d2"),
    )
    within = W.partitionBy("conv", "piece").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    ran = common.stored(
        rows.withColumns({"r1": F.bit_xor("d1").over(within), "r2": F.bit_xor("d2").over(within)}), "trie-totals"
    )
    ends = ran.filter((F.col("depth") + 1) % piece == 0).select("conv", (F.col("piece") + 1).alias("piece"), "r1", "r2")
    before = W.partitionBy("conv").orderBy("piece").rowsBetween(W.unboundedPreceding, 0)
    carried = ends.select(
        "conv", "piece", F.bit_xor("r1").over(before).alias("c1"), F.bit_xor("r2").over(before).alias("c2")
    )
    k1, k2 = (
        F.col(f"r{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0).cast("bigint"))) for i in (1, 2)
    )
    return ran.join(carried, ["conv", "piece"], "left").select(
        "conv", "length", "depth", "bytes", F.struct(k1.alias("k1"), k2.alias("k2")).alias("key"),
        F.struct(k1.bitwiseXOR(F.col("d1")).alias("k1"), k2.bitwiseXOR(F.col("d2")).alias("k2")).alias("parent"),
    )


def _banded(rows: DataFrame, step: int, band: int) -> DataFrame:
    """(key, foot, up) of the nodes at multiples of ``step``: their ancestors there within the band.

    A node's ``up`` begins at its band's root and ends with itself. A band's root also is a foot of the
    band above, whose ``up`` are the nodes there that it hangs below.
    """
    at = F.col("depth") / step
    marked = rows.filter(F.col("depth") % step == 0).select("conv", "key", at.cast("bigint").alias("at"))
    bands = F.when((F.col("at") % band == 0) & (F.col("at") > 0), F.array(F.floor(F.col("at") / band), F.floor(F.col("at") / band) - 1))
    placed = marked.withColumn("band", F.explode(F.coalesce(bands, F.array(F.floor(F.col("at") / band)))))
    path = W.partitionBy("conv", "band").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    seen = placed.withColumn("path", F.collect_list("key").over(path))
    foot = F.floor(F.col("at") / band) > F.col("band")
    up = F.when(foot, F.slice("path", 1, F.size("path") - 1)).otherwise(F.col("path"))
    return seen.select("key", foot.alias("foot"), up.alias("up")).groupBy("key", "foot").agg(F.any_value("up").alias("up"))


def rolled_up(values: DataFrame, rows: DataFrame, deepest: int, names: list[str], band: int) -> DataFrame:
    """(key, *names): the sums of ``values`` (key, *names) over every node's subtree."""
    levels, step = [], 1
    own = values
    while True:
        tree = common.stored(_banded(rows, step, band), "trie-bands")
        levels.append((tree, own))
        step *= band
        if step > deepest:
            break
        # the totals of a band belong to its root
        own = common.stored(
            tree.filter("not foot").join(own, "key").groupBy(F.col("up")[0].alias("key")).agg(*[F.sum(n).alias(n) for n in names]),
            "trie-roots",
        )
    above = None
    for tree, own in reversed(levels):
        handed = tree.filter("not foot").join(own, "key")
        if above is not None:
            handed = handed.unionByName(tree.filter("foot").join(above, "key"))
        spread = handed.select(F.explode("up").alias("key"), *names)
        above = common.stored(spread.groupBy("key").agg(*[F.sum(n).alias(n) for n in names]), "trie-sums")
    return above


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for all pieces of a node, which arrive in order."""
    current, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != current:
                if state is not None:
                    keys.append(current)
                    hashes.append(state.hexdigest())
                current, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _ended(keys, hashes)
    if state is not None:
        yield _ended([current], [state.hexdigest()])


def _ended(keys: list[dict], hashes: list[str]) -> pa.RecordBatch:
    kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(hashes, pa.string())], names=["key", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes that conversations end at.

    The ids of a node are written in pieces of IDS, so that a node at which a third of all
    conversations end is ordered and joined up by many tasks; one only hashes the pieces in turn.
    """
    last = rows.filter("depth = length").select("key", "conv")
    placed = lists.with_positions(last, "key", [F.col("conv")], "place")
    pieces = placed.groupBy("key", F.floor(F.col("place") / IDS).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    dealt = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return dealt.mapInArrow(_hashed_ids, f"key {KEY}, ends_sha256 string")


def trie(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    band: int = BAND, piece: int = PIECE,
) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, NULL first, then by role and by the digest of role and text, so rows
    that differ in nothing are turns of their own. NULL roles and texts are empty ones. Conversation c
    is rebuilt from the first h turns of c - c % 5 (the remainder has the sign of c) and its own after
    its first h, h = crc32(c) % 9; it may be left without turns, and is then a member of the root only.
    Rows with a NULL id belong to no conversation and are left out. An empty table gives an empty
    result. Texts of any length enter as digests; columns besides the four are not read.
    """
    sequences = rebuilt(turn_rows(turns, conversation, turn, role, text))
    rows = common.stored(keyed(sequences, piece), "trie-rows")
    nodes = common.stored(
        rows.groupBy("key").agg(
            F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"),
            F.max("bytes").alias("bytes"), F.any_value("parent").alias("parent"),
        ), "trie-nodes",
    )
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    known = common.stored(
        nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children"
    )
    values = known.select(
        "key", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = rolled_up(values, rows.select("conv", "key", "depth"), deepest, ["n_leaves", "saved_tokens"], band)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    lowest = known.filter("depth > 0").join(parents, "parent").select("key", "parent_conv_id")
    return (
        known.join(sums, "key").join(lowest, "key", "left").join(ends(rows), "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


@query("op12_prefix_trie")
def op12_prefix_trie(spark, sf):
    return trie(common.table(spark, sf, "conversations"))


ORACLES["op12_prefix_trie"] = """
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
  from conversations where conv_id is not null
), listed as (
  select conv_id, list({'role': role, 'text': text} order by place) as own from turns group by conv_id
), known as (
  select conv_id, own, conv_id - conv_id % 5 as base, conv_id::varchar as digits from listed
), crc as (
  select conv_id, own, base, xor(list_reduce(
    [4294967295::bigint] || list_transform(range(1, length(digits) + 1), lambda i: ascii(digits[i])::bigint),
    lambda a, b: list_reduce([xor(a, b)] || range(8), lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)
  ), 4294967295) % 9 as h from known
), rebuilt as (
  select c.conv_id, coalesce(b.own[1:c.h], []) || c.own[c.h + 1:] as seq from crc c left join listed b on b.conv_id = c.base
), prefixes as (
  select conv_id, d, seq[1:d] as prefix, len(seq) = d as ends from (select *, unnest(range(len(seq) + 1)) as d from rebuilt)
), nodes as (
  select md5(prefix::varchar) as node, any_value(prefix) as prefix, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from prefixes group by prefix, d
), paths as (
  select n.conv_id, n.depth, n.node, p.d, md5(p.prefix::varchar) as above
  from nodes n join prefixes p on p.conv_id = n.conv_id and p.d <= n.depth
), children as (
  select above as node, count(*) as n_children from paths where d = depth - 1 group by above
), own as (
  select n.*, coalesce(n_children, 0) as n_children,
         case when depth = 0 then 0 else (n_convs - 1) * octet_length(encode(prefix[depth].text)) end as saved
  from nodes n left join children using (node)
), sums as (
  select p.above as node, count(*) filter (o.n_children = 0) as n_leaves, sum(o.saved) as saved_tokens
  from paths p join own o on o.node = p.node group by p.above
)
select o.conv_id, o.depth::bigint as depth, u.conv_id as parent_conv_id, o.n_convs::bigint as n_convs,
       o.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, o.ends_sha256
from own o join sums s using (node) left join paths p on p.node = o.node and p.d = o.depth - 1
left join nodes u on u.node = p.above
"""
