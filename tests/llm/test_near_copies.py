"""The pipeline's near-dedup against all pairs, on crowds that share much without being copies."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline import session
from sightline.llm import common, simhash

SCHEMA = "doc_id bigint, text string"


def brute(rows, reachable):
    sets = [frozenset(simhash.shingles(t or "", simhash.KEEP_WORDS).tolist()) for _, t in rows]

    def linked(a, b):
        x, y = sets[a], sets[b]
        return x == y or 5 * len(x & y) >= 4 * len(x | y)

    tops, least = reachable(range(len(rows)), linked), {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[tops[k]] = min(least.get(tops[k], i), i)
    return sorted(str((i, least.get(tops[k]))) for k, (i, _) in enumerate(rows))


def found(df):
    return sorted(str((r.doc_id, r.component_id)) for r in simhash.near_copies(df).collect())


@pytest.fixture()
def candidates(monkeypatch):
    """Rows of the tables that candidate pairs are written to."""
    seen, real = [], common.stored

    def stored(df, label, *args):
        made = real(df, label, *args)
        if label in ("simhash-stars", "simhash-rest"):
            seen.append(made.count())
        return made

    monkeypatch.setattr(common, "stored", stored)
    return seen


def crowd(prose, n, own, shared=60):
    """Texts around one passage, with ``own`` words of their own before and behind."""
    passage = prose(shared, 1)
    return [(i, f"{prose(own, 1000 + 2 * i)} {passage} {prose(own, 1001 + 2 * i)}") for i in range(n)]


def edited(prose, n, words=200, seed=3):
    """Copies of one text with a few words changed; not all of them are near copies of each other."""
    rng, base = random.Random(seed), prose(words, seed).split()
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(words)] = f"changed{rng.randrange(1000)}"
        rows.append((10_000 * seed + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("own", [4, 7, 11])
def test_a_crowd_around_one_passage_makes_few_candidates(spark, prose, reachable, candidates, own):
    """With 4 own words on both sides most pairs are just above or below the limit, with 11 well below it."""
    rows = crowd(prose, 250, own) + edited(prose, 60)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows, reachable)
    assert sum(candidates) < 20 * len(rows)


def test_edited_copies_of_one_text_make_few_candidates(spark, prose, reachable, candidates):
    """A pair for a pair would be 300 times the rows; most are just above or below the limit."""
    rng, base = random.Random(7), prose(150, 7).split()
    rows = []
    for i in range(600):
        text = list(base)
        for _ in range(rng.randrange(7)):
            text[rng.randrange(150)] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows, reachable)
    assert sum(candidates) < 5 * len(rows)


def test_parities_never_pass_over_similar_sets():
    rng = np.random.default_rng(5)
    for n in (0, 1, 5, 100, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for gone in {0, n // 20, n // 9, n}:
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, gone // 2, dtype=np.uint64)]))
            apart = sum(int(x ^ y).bit_count() for x, y in zip(*(simhash.parities(s).view(np.uint64) for s in (a, b))))
            assert apart <= len(np.setxor1d(a, b))


def test_all_pairs_of_texts_and_groups(spark, prose, reachable, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == brute(rows, reachable)
    rows = edited(prose, 80, 120, 1) + edited(prose, 80, 60, 2) + [(i, prose(i % 9, i)) for i in range(100)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows, reachable)


def test_odd_rows_and_no_rows(spark, odd, reachable):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(odd) == brute(rows, reachable)
    assert simhash.near_copies(odd.limit(0)).collect() == []
    left = simhash.keep_one(odd)
    assert left.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert len(kept) == len(set(kept)) and (1, "a plain text of a few words") in kept
    assert len([t for _, t in kept if not (t or "").split()]) == 1  # NULL, empty and blank ones are one class


def test_scratch_is_removed_and_the_result_stays(spark, prose):
    rows = edited(prose, 20)
    with session.noting() as made:
        result = simhash.near_copies(spark.createDataFrame(rows, SCHEMA))
    from sightline.sources import folders

    left = [p for p in made if folders.exists(spark, p)]
    assert len(left) == 2 and result.count() == 20  # the sketches and the classes


def test_stages_take_odd_rows_and_none(spark, odd):
    """All five stages over odd rows, and over none: they write and read as the pipeline does."""
    import corpus_pipeline

    clean = odd.withColumn("text", F.col("text"))
    for docs in (clean, clean.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, "/root/testdata/sf0.001"), "test-stage")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns, name
        assert set(docs.columns) >= {"doc_id", "start", "n_tokens"}
