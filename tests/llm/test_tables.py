"""Whitening, the prefix trie and multiset fingerprints against plain definitions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import multiset, prefixtrie, whitening
from sightline.llm.registry import ORACLES

VECTORS = "vec_id bigint, embedding array<double>, n bigint, v string, component int"


def integers(v):
    return [math.floor(1024 * c) + 100_000 for c in v]


def plain_whitening(rows, most=8):
    """{vec_id: (deviation, {component: whitened})}, explained, by an ordinary eigensolver."""
    x = [integers(v) for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    z = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    cov = z.T @ z / n
    e, c = np.linalg.eigh(cov)
    e, c = e[::-1], c[:, ::-1]
    rank = int((e > len(e) * 1e-14 * e[0]).sum())
    shown = z @ c[:, : min(most, rank)] / np.sqrt(e[: min(most, rank)])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return shown, deviations, e / e.sum()


def drawn(n, size, seed=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, size)) @ np.diag(1.5 ** -np.arange(size)) @ np.linalg.qr(rng.normal(size=(size, size)))[0]


def whitened(df):
    out = defaultdict(dict)
    for r in df.collect():
        out[r.vec_id][r.component] = r
    return out


def test_whitening_equals_an_eigensolver(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(drawn(300, 12))]
    df = spark.createDataFrame([(i, v, 7, "x", 1) for i, v in rows], VECTORS).repartition(5)
    got = whitened(whitening.whiten(df))
    shown, deviations, explained = plain_whitening(rows)
    assert len(got) == 300 and all(sorted(g) == list(range(1, 9)) for g in got.values())
    signs = np.sign([got[0][k + 1].whitened * shown[0][k] for k in range(8)])
    for i in range(300):
        assert got[i][1].n == 300 and got[i][1].deviation == deviations[i]
        assert np.allclose([got[i][k + 1].whitened for k in range(8)], shown[i] * signs, rtol=1e-9, atol=1e-9)
        assert np.allclose([got[i][k + 1].explained for k in range(8)], explained[:8], rtol=1e-9)
    assert got[0][1].identity_error < 1e-10


def test_whitening_keeps_small_eigenvalues(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 6)) * np.array([1e6, 1e4, 1e2, 1, 1e-1, 1e-2])
    got = whitened(whitening.whiten(spark.createDataFrame([(i, r.tolist(), 0, "", 0) for i, r in enumerate(v)], VECTORS)))
    shown, _, explained = plain_whitening(list(enumerate(v.tolist())))
    assert sorted(got[0]) == [1, 2, 3, 4, 5, 6] and got[0][1].identity_error < 1e-8
    assert np.allclose([got[0][k + 1].explained for k in range(6)], explained, rtol=1e-4)


def test_whitening_of_odd_rows(spark):
    far = [1e300, -1e300, 1e-300]
    rows = [
        (1, [1.0, 0.0, 0.5]), (1, [1.0, 0.0, 0.5]), (None, [0.0, 2.0, 0.1]), (2, None), (3, []), (4, [1.0, None, 0.0]),
        (5, [1.0, float("nan"), 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, [1.0, 2.0]), (8, [0.3, 0.4, 9.0]), (9, [0.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 0, "", 0) for i, v in rows], VECTORS)
    got = whitening.whiten(df).collect()
    assert sorted({r.vec_id for r in got}, key=str) == sorted([1, None, 8, 9], key=str)
    assert len([r for r in got if r.vec_id == 1]) == 6 and {r.n for r in got} == {5}
    assert {r.component for r in got} == {1, 2, 3} and got[0].identity_error < 1e-10
    huge = whitening.whiten(spark.createDataFrame([(i, v, 0, "", 0) for i, v in [*rows, (10, far)]], VECTORS)).collect()
    assert {r.deviation for r in huge if r.vec_id == 10} == {None} and all(math.isfinite(r.whitened) for r in huge)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id = 1")).collect() == []  # equal rows only: no direction
    assert whitening.whiten(df.filter("vec_id = 8")).collect() == []


def test_factor_and_rotation_give_the_matrix_back():
    rng = np.random.default_rng(9)
    for size, rank in ((1, 1), (7, 7), (20, 5), (33, 33)):
        half = rng.normal(size=(size, rank))
        a = half @ half.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape == (size, rank) and np.allclose(factor @ factor.T, a)
        values, parts = whitening.one_sided_jacobi(factor)
        assert np.allclose(parts.T @ parts, np.eye(rank), atol=1e-13) and (np.diff(values) <= 0).all()
        assert np.allclose((parts * values) @ parts.T, a) and np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank])


def test_deviations_at_the_edge_of_64_bits():
    centre = whitening.Centre(3, [0, 1])
    x = np.array([[0.0, 0.0], [5e8, 1.0], [1e9, 7.0], [1.1e9, 0.0]])
    plain = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, (0, 1))) for row in x]
    assert centre.deviations(x) == [p if p < 1 << 63 else None for p in plain] and plain[3] >= 1 << 63


TURNS = "conv_id bigint, turn bigint, role string, text string, key string, depth int, place string, digest string"


def as_turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], TURNS)


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        worth = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += worth
    return sorted(str((
        min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in sorted(m) if seqs[c] == list(p)).encode()).hexdigest(),
    )) for p, m in members.items())


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def as_nodes(df):
    return sorted(str(tuple(r)) for r in df.select(*NODE).collect())


def conversations(n, longest, seed=1):
    rng = random.Random(seed)
    return [
        (c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "cc"]))
        for c in range(-3, n) for t in range(rng.randint(0, longest)) if c % 7
    ]


@pytest.mark.parametrize("band, piece", [(2, 3), (3, 4), (16, 4096)])
def test_trie_equals_the_plain_one(spark, band, piece):
    rows = conversations(60, 12) + [(1000, t, "user", f"turn {t}") for t in range(40)]
    rows += [(1001, t, "user", f"turn {t}") for t in range(37)] + [(None, 0, "user", "nobody"), (5, 0, "user", "a"), (5, 0, "user", "a")]
    df = as_turns(spark, rows).repartition(4)
    assert as_nodes(prefixtrie.trie(df, band=band, piece=piece)) == plain_trie(rows)


def test_trie_of_copies_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "IDS", 7)  # the ids of the copies are hashed in many pieces
    rows = [(c * 5, t, "user", f"same {t}") for c in range(300) for t in range(3)] + [(1501, 0, "user", "x" * 200_000)]
    assert as_nodes(prefixtrie.trie(as_turns(spark, rows).repartition(6))) == plain_trie(rows)
    assert prefixtrie.trie(as_turns(spark, [])).collect() == []


def test_no_trie_value_is_copied_more_often_than_the_band_is_high(spark):
    rows = as_turns(spark, [(5, t, "user", f"turn {t}") for t in range(200)])
    numbered = prefixtrie.keyed(prefixtrie.rebuilt(prefixtrie.turn_rows(rows, "conv_id", "turn", "role", "text")), 64)
    for step in (1, 4, 16, 64):
        tree = prefixtrie._banded(numbered, step, 4)
        assert tree.agg(F.max(F.size("up"))).first()[0] <= 4


def plain_lanes(text):
    lanes = [0] * multiset.LANES
    if text:
        for p in text.split("\n"):
            data = b"".join(hashlib.sha256(k + p.encode()).digest() for k in (b"0", b"1"))
            for i in range(multiset.PROOF):
                lanes[i] += int.from_bytes(data[4 * i: 4 * i + 4], "big")
            codes = [0] * (multiset.WINDOW - 1) + [ord(c) + 1 for c in p]
            for i in range(len(p)):
                window = codes[i: i + multiset.WINDOW][::-1]
                h = sum(f * c for f, c in zip(multiset.FACTORS, window)) % multiset.PRIME % (2 * multiset.LIKE)
                lanes[multiset.PROOF + h % multiset.LIKE] += 1 if h < multiset.LIKE else -1
    return "".join(f"{x % 2**32:08x}" for x in lanes)


def plain_edits(rows):
    def order(r):
        return r[0] is not None, r[0] or 0

    rows = sorted(rows, key=order)
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        k = len(text) // 2
        edited = text[: len(text) - k] + after[:k]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_lanes(text), plain_lanes(edited)))
    return sorted(out, key=str)


TEXTS = ["", None, "one", "two\nlines", "\n\n", "lines\ntwo", "ÄÖ😀 中文\n" * 40, "x" * 3000, "a b c\0d e f", "For " * 500]


@pytest.mark.parametrize("rows_in_range", [4096, 1, 3])
def test_edits_equal_the_plain_ones(spark, prose, monkeypatch, rows_in_range):
    monkeypatch.setattr(multiset, "ROWS", rows_in_range)  # many ranges: every range's end meets the next one's start
    rows = [(3 * i - 5, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (1000, prose(300, 1)), (1001, prose(300, 2))]
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id bigint, text string, tie string, range int")
    got = multiset.compared_with_edits(df.repartition(3)).collect()
    assert sorted(((*r[:5],) for r in got), key=str) == plain_edits(rows)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1.0) or r.fingerprint != r.edited_fingerprint
    long = {r.doc_id: r for r in got}[1000]
    assert abs(long.near_edited - 0.5) < 0.25 and long.near_next < 0.35


def test_edits_of_repeated_odd_and_no_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(multiset, "ROWS", 1)
    got = multiset.compared_with_edits(odd)
    assert got.count() == odd.count()
    assert multiset.compared_with_edits(odd.limit(0)).collect() == []
    same = spark.createDataFrame([(1, "copy of a text")] * 50 + [(2, "b")] * 3, "doc_id bigint, text string")
    rows = multiset.compared_with_edits(same).collect()
    assert len(rows) == 53 and len({r.fingerprint for r in rows}) == 2
    alone = multiset.compared_with_edits(same.limit(1)).first()
    assert (alone.near_next, alone.n_chars) == (1.0, 14)
    assert alone.edited_sha256 == hashlib.sha256(b"copy ofcopy of").hexdigest()


def test_likeness_follows_what_two_texts_share(prose):
    text = prose(2000, 5)
    words = text.split()
    for share in (0.0, 0.25, 0.5, 0.75, 0.95):
        cut = int(len(words) * share)
        other = " ".join(words[:cut] + prose(2000, 6).split()[cut:])
        assert abs(multiset.likeness(multiset.vector(text), multiset.vector(other)) - share) < 0.35
    assert multiset.likeness(multiset.vector(text), multiset.vector(text)) == 1.0
    assert multiset.likeness(multiset.vector(""), multiset.vector("")) == 1.0
    assert multiset.likeness(multiset.vector(""), multiset.vector(text)) == 0.0


def test_fingerprints_are_of_multisets_and_can_be_updated(spark, prose):
    parts = [prose(20, i) for i in range(6)] + ["", "again", "again"]
    turned = parts[::-1]
    rows = [(1, "\n".join(parts)), (2, "\n".join(turned)), (3, "\n".join(parts[:-1])), (4, "\n".join(parts[2:])), (5, "kept"), (6, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, fingerprint string")
    prints = {r.doc_id: r.fingerprint for r in multiset.fingerprints(docs).collect()}
    assert prints[1] == prints[2] == plain_lanes(rows[0][1]) and prints[1] != prints[3] and prints[6] == "0" * 8 * multiset.LANES
    changes = [(3, "again", True), (4, parts[0], True), (4, parts[1], True), (7, "new", True), (1, "again", False), (5, "kept", False)]
    changes += [(2, "hot", True)] * 500 + [(2, "hot", False)] * 499 + [(6, None, True), (None, "x", True), (5, "x", None)]
    table = spark.createDataFrame(changes, "doc_id bigint, paragraph string, inserted boolean").repartition(4)
    after = {r.doc_id: r.fingerprint for r in multiset.updated(multiset.fingerprints(docs), table).collect()}
    assert after[3] == prints[1] and after[4] == prints[1] and after[1] == prints[3] and after[7] == plain_lanes("new")
    assert after[2] == plain_lanes(rows[1][1] + "\nhot") and after[5] == prints[6] == "0" * 8 * multiset.LANES
    assert after[6][: 8 * multiset.PROOF] == "".join(hashlib.sha256(k).hexdigest() for k in (b"0", b"1"))


def test_a_very_long_text_is_sketched_in_parts(prose, monkeypatch):
    text = "\n".join(prose(50, i) for i in range(30))
    whole = multiset.vector(text)
    monkeypatch.setattr(multiset, "STRIDE", 13)
    assert (multiset.vector(text) == whole).all()


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_multiset_fingerprint"])
def test_queries_equal_their_sql(spark, name):
    from sightline.llm.registry import QUERIES
    from tools import check_oracle

    folder = "/root/testdata/sf0.001"
    assert check_oracle.difference(check_oracle.duck(folder), ORACLES[name], QUERIES[name](spark, folder)) is None


def test_odd_rows_through_the_sql(spark):
    rows = conversations(40, 10, seed=4)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    result = con.execute(f"select {', '.join(NODE)} from ({ORACLES['op12_prefix_trie']})").fetchall()
    assert sorted(str(r) for r in result) == plain_trie(rows) == as_nodes(prefixtrie.trie(as_turns(spark, rows)))
