import random

import pytest

LONG = " ".join(f"word{i % 977}" for i in range(40_000))
#: (id, text): NULLs in both, repeated rows and ids, empty, blank, ties, a very long text, odd characters.
ODD = [
    (1, "a plain text of a few words"), (1, "a plain text of a few words"), (1, "another text under one id"),
    (2, None), (3, ""), (4, "   \n\t "), (None, "a text without an id"), (None, None), (5, "one"), (6, "one two"),
    (7, LONG), (8, "ÄÖÜ ß 中文 😀 é  x"), (9, "A PLAIN TEXT OF A FEW WORDS"), (-7, "negative id"),
]
#: Columns of other meaning under names that operators might use inside.
CLASHES = ["_text", "_id", "digest", "fp", "place", "_place", "_copies", "_gone_id", "row", "id", "n", "block", "label_", "_words"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows as documents with extra columns."""
    from pyspark.sql import functions as F

    rows = [(i, t, "en" if k % 2 else None, f"s{k % 3}" if k % 4 else None, len(t or "")) for k, (i, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit("extra").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def prose():
    """A maker of texts over a small vocabulary."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    return lambda n, seed: " ".join(random.Random(seed).choices(words, k=n))


def links(nodes, linked):
    """node -> smallest node reachable."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.fixture(scope="session")
def reachable():
    return links
