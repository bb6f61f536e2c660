"""SimHash and embedding near-duplicates against all pairs."""

import math
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sightline.llm import common, gridjoin, simhash

SCHEMA = "doc_id bigint, text string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, reachable):
    prints = [plain_fingerprint(t) for _, t in rows]
    tops = reachable(range(len(rows)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[tops[k]] = min(least.get(tops[k], i), i)
    return sorted(str((i, f"{prints[k]:016x}", least.get(tops[k]))) for k, (i, _) in enumerate(rows))


def near_rows(prose):
    rows = []
    for g in range(12):
        words = prose(300, g).split()
        for c in range(8):
            changed = list(words)
            for k in range(c // 2):
                changed[random.Random(c).randrange(300)] = f"new{k}"
            rows.append((g * 10 + c, " ".join(changed)))
    return rows


def test_classes_equal_all_pairs(spark, prose, odd, documents, reachable):
    for df in (spark.createDataFrame(near_rows(prose), SCHEMA), documents, odd):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        if df is odd:
            rows = [r for r in rows if r[0] is not None]
            df = df.filter("doc_id is not null")
        got = sorted(str(tuple(r)) for r in simhash.near_duplicates(df).collect())
        assert got == expected(rows, reachable)


def test_null_ids_follow_their_fingerprint(spark):
    rows = [(None, "some text of words"), (4, "some text of words"), (None, "quite another one")]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(None, 4), (4, 4), (None, None)}


def test_large_shards_are_cut_without_losing_links(spark, reachable):
    """Thousands of fingerprints that agree in most blocks, far beyond a shard's limit."""
    rng = random.Random(2)
    values = list({rng.getrandbits(16) << 4 for _ in range(500)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [simhash._signed(v) for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    edges = [
        (values.index(a), values.index(b))
        for part in simhash._shards(fps, 2, 40) for row in part.collect()
        for a, b in simhash.forest([f & (1 << 64) - 1 for f in row.fps], 2)
    ]
    assert all((values[a] ^ values[b]).bit_count() <= 2 for a, b in edges)
    want = reachable(range(len(values)), lambda a, b: (values[a] ^ values[b]).bit_count() <= 2)
    linked = set(edges) | {(b, a) for a, b in edges}
    assert reachable(range(len(values)), lambda a, b: (a, b) in linked) == want


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(1)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for radius in (0, 1, 3):
        for v in values[:40]:
            assert sorted(tree.within(v, radius)) == sorted({x for x in values if (x ^ v).bit_count() <= radius})


def test_one_of_each_group_stays_with_all_columns(spark, odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    got = sorted(str((r.doc_id, r.text)) for r in kept.collect())
    texts = [r.text for r in odd.filter("doc_id is not null").collect()]
    assert sum("a plain text of a few words" in g for g in got) == 1  # repeated rows are one
    assert len([g for g in got if g.startswith("(-7") or g.startswith("(7,")]) == 2 and len(texts) > len(got) - 2
    assert simhash.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []


def test_near_copies_equal_all_pairs(spark, prose, reachable):
    """Every pair with a Jaccard similarity of 0.8 or more links, and no other, however far their fingerprints are apart."""
    rows = []
    for g in range(40):
        words = prose(400, 300 + g).split()
        for c in range(6):
            changed = list(words)
            for k in range(3 * c):
                changed[random.Random(g * 10 + c * 100 + k).randrange(400)] = f"new{g}x{c}x{k}"
            rows.append((g * 10 + c, " ".join(changed)))
    rows += [(1001, ""), (1002, None), (1003, "one two"), (1004, "ONE  two")]
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    same = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if same(a, b)]
    far = [p for p in pairs if (prints[p[0]] ^ prints[p[1]]).bit_count() > 3]
    assert len(far) > 40
    tops = reachable(range(len(rows)), same)
    want = sorted((i, rows[tops[k]][0]) for k, (i, _) in enumerate(rows))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_copies(docs, "text", "doc_id").collect())
    assert got == want
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    assert kept == sorted({i for _, i in want})


def test_components_of_long_chains(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(1, 200).select((F.col("id") + 1000).alias("a"), F.lit(1000).cast("bigint").alias("b"))
    found = {r.node: r.component for r in common.components(chain.union(star), "test").collect()}
    assert found == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint"), "test").collect() == []


# --- embeddings ------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_links(rows):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, dtype=np.float32).astype(float)
        return a / np.linalg.norm(a)

    units = [unit(v) if label is not None else None for _, v, label in rows]
    near = lambda a, b: (
        units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b])
        and float(units[a] @ units[b]) >= 0.93
    )
    return units, near


def clusters(seed, size=24):
    rng, rows = np.random.default_rng(seed), []
    for c in range(14):
        centre = rng.normal(size=size)
        for k in range(30):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + rng.normal(scale=0.12 + 0.02 * (c % 5), size=size)], c % 3))
    for k in range(25):  # copies
        rows.append((len(rows), rows[5][1], rows[5][2]))
    return rows


def test_grid_join_equals_all_pairs(spark, reachable, monkeypatch):
    monkeypatch.setattr(gridjoin, "BLOCK", 16)
    monkeypatch.setattr(gridjoin, "FAN", 3)
    rows = clusters(4)
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 0), (1001, [0.0] * 24, 0), (1002, [nan] + [1.0] * 23, 0), (1003, [inf] + [1.0] * 23, 0),
             (1004, rows[5][1], None), (1005, [], 0), (1006, [1.0, None, 2.0], 1), (1007, [1.0, 2.0], 0), (1008, [1.0, 2.0], 0),
             (1009, [1.0, 2.0], 1), (1007, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).select("*", F.lit(1).alias("n"), F.lit("x").alias("space"), F.lit(2).alias("node"))
    _, near = plain_links(rows)
    tops = reachable(range(len(rows)), near)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[tops[k]] = min(least.get(tops[k], i), i)
    links = [sum(near(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    want = sorted((i, links[k], least[tops[k]], least[tops[k]] == i) for k, (i, _, _) in enumerate(rows))
    got = sorted(tuple(r) for r in gridjoin.near_duplicates(df).collect())
    assert got == want
    assert sum(links) > 1000


def test_far_blocks_are_skipped(spark):
    boxes = spark.createDataFrame(
        [("s", b, [b * 1.0] * gridjoin.AXES, [b + 0.1] * gridjoin.AXES) for b in range(40)],
        "space string, b bigint, lo array<double>, hi array<double>",
    )
    pairs = gridjoin._block_pairs(boxes, 0.3).collect()
    assert sorted((r.b1, r.b2) for r in pairs) == [(b, b) for b in range(40)]


def test_grid_join_of_nothing_and_of_null_ids(spark):
    assert gridjoin.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    got = {tuple(r) for r in gridjoin.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == {(None, 1, 3, False), (3, 1, 3, True), (None, 0, None, False)}


def test_vectors_of_extreme_lengths_link_by_their_direction(spark):
    base = np.random.default_rng(2).normal(size=8)
    other = np.random.default_rng(3).normal(size=8)
    rows = [(0, base), (1, base * 1e200), (2, base * 1e-200), (3, other * 1e306), (4, other * 1e-300), (5, -base), (6, base * 1e-320)]
    df = spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in rows], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in gridjoin.near_duplicates(df).collect()}
    assert {i: got[i] for i in (0, 1, 2)} == {0: (2 + (got[6][1] == 0), 0), 1: (2 + (got[6][1] == 0), 0), 2: (2 + (got[6][1] == 0), 0)}
    assert got[3] == (1, 3) and got[4] == (1, 3) and got[5] == (0, 5)
