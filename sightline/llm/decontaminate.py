"""Benchmark decontamination: a BM25 index of the test items, searched by block-max WAND.

A text holds an item if a passage of it, up to ``STRETCH`` times as long as the item, has enough of the
item's shingles. Every passage of every training text is searched: windows of twice the longest such
passage, half overlapping, so that every passage lies whole in one window. Items of about one length have
an index and windows of their own, so short items are not sought in long windows. All items are retrieved that score above their threshold, and then verified word by word, over all passages of the
window: an item into which words were put is found wherever it stands.

The threshold of an item is its own score less what a verified passage may lack at most, so nothing
that would be verified is missed, whatever the weights. Bounds are tested for many windows at once
(list maxima, then block maxima over blocks of items); WAND runs on the windows that pass.

The index is what is broadcast. Items of more than ``PART_BYTES`` are indexed in parts, one pass over
the texts each. What is found does not depend on the cut, because verification is exact and an item's
passages depend on the item alone; only scores are by the weights of the item's part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

K1, B = 1.2, 0.75
#: Words in a shingle, and the part of an item's shingles (and its answer's words) a passage must have.
SHINGLE, OVERLAP = 5, 0.8
#: Length of a passage, in lengths of the item.
STRETCH = 2
#: Items in a block at least, and blocks at most.
BLOCK, BLOCKS = 4, 64
PART_BYTES = 8 << 20
#: Windows whose block bounds are formed at once.
WINDOWS = 64

_SPLIT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case runs of letters and digits of any script; all else separates them."""
    text = text.lower()
    if not text.isascii():
        others = [c for c in set(text) if c > "\x7f" and not c.isalnum()]
        if others:
            text = text.translate(dict.fromkeys(map(ord, others), " "))
    return text.encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def shingles(found: list[bytes]) -> set[bytes]:
    if not found:
        return set()
    return {b" ".join(found[i : i + SHINGLE]) for i in range(max(1, len(found) - SHINGLE + 1))}


class Index:
    """Postings with BM25 weights.

    Items are numbered by the score they need and blocks are runs of numbers, so that the items of a
    block need about the same and its bound is tight.
    """

    def __init__(self, items: list[tuple[int, str]], overlap: float = OVERLAP):
        parts = [(i, *self._question_and_answer(text)) for i, text in items]
        parts = [p for p in parts if p[1]]
        bags = [Counter(p[1] + p[2]) for p in parts]
        lengths = [sum(b.values()) for b in bags]
        self.spans = {p[0]: STRETCH * n for p, n in zip(parts, lengths)}
        self.stride = max(self.spans.values(), default=1)
        average = sum(lengths) / len(lengths) if lengths else 1.0
        self.terms = {w: n for n, w in enumerate(sorted({w for b in bags for w in b}))}
        df = Counter(w for b in bags for w in b)
        made = []
        for (item, question, answer), bag, length in zip(parts, bags, lengths):
            weights = {}
            for w, tf in bag.items():
                idf = np.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5))
                weights[w] = float(idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average)))
            # a missing word breaks at least one shingle, so a verified passage lacks at most this many
            cut, words_of = shingles(question), set(answer)
            lacking = int((1 - overlap) * len(cut) + 1e-9) + int((1 - overlap) * len(words_of) + 1e-9)
            least = sum(sorted(weights.values())[: max(0, len(weights) - lacking)]) - 1e-6
            made.append((least, item, cut, words_of, weights))
        made.sort(key=lambda m: m[:2])
        self.needed, self.ids, self.questions, self.answers = ([m[i] for m in made] for i in range(4))
        self.overlap = overlap
        lists: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for n, m in enumerate(made):
            for w, weight in m[4].items():
                lists[self.terms[w]].append((n, weight))
        self.floor = min(self.needed, default=np.inf)
        self.block = max(BLOCK, -(-len(bags) // BLOCKS))
        blocks = -(-len(bags) // self.block)
        self.lists = [([n for n, _ in p], [w for _, w in p]) for p in lists]
        self.most = np.array([max(w for _, w in p) for p in lists], dtype=np.float32)
        self.block_most = np.zeros((len(lists), blocks), dtype=np.float32)
        for t, p in enumerate(lists):
            for n, w in p:
                self.block_most[t, n // self.block] = max(self.block_most[t, n // self.block], w)
        self.block_floor = np.array(
            [min(self.needed[b * self.block : (b + 1) * self.block]) for b in range(blocks)], dtype=np.float32
        )

    @staticmethod
    def _question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
        """Up to the last question mark, and what follows; without one, all of it and nothing."""
        head, mark, tail = text.rpartition("?")
        return (words(head), words(tail)) if mark and words(head) else (words(text), [])

    def windows(self, terms: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(window, its distinct terms) of a text's windows that some item's bound allows.

        ``terms`` has each word's term, -1 for words of no item; window w starts at word w * stride.
        """
        at = np.flatnonzero(terms >= 0)
        if not len(at):
            return
        own, term = at // self.stride, terms[at]
        both = np.concatenate([own, own[own > 0] - 1]), np.concatenate([term, term[own > 0]])
        pairs = np.unique(both[0] * len(self.lists) + both[1])
        window, term = pairs // len(self.lists), pairs % len(self.lists)
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        last = np.append(first[1:], len(window))
        slack = 1 + 1e-5
        near = np.flatnonzero(np.add.reduceat(self.most[term], first) * slack >= self.floor)
        for at in range(0, len(near), WINDOWS):
            some = near[at : at + WINDOWS]
            sizes = last[some] - first[some]
            starts = np.cumsum(sizes) - sizes
            own = term[np.arange(int(sizes.sum())) + np.repeat(first[some] - starts, sizes)]
            bounds = np.add.reduceat(self.block_most[own], starts, axis=0)
            for k in some[(bounds * slack >= self.block_floor).any(axis=1)]:
                yield int(window[first[k]]), term[first[k] : last[k]]

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """(item number, score) of all items that score what they need, by block-max WAND."""
        cursors = [[self.lists[t][0][0], 0, t] for t in terms]  # item, position in the list, term
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for item, _, t in cursors:
                bound += self.most[t]
                if bound * (1 + 1e-5) >= self.floor:
                    pivot = item
                    break
            if pivot < 0:
                break
            block = pivot // self.block
            near = [c for c in cursors if c[0] <= pivot]
            if sum(self.block_most[c[2], block] for c in near) * (1 + 1e-5) < self.block_floor[block]:
                target = (block + 1) * self.block
                beyond = next((c[0] for c in cursors if c[0] > pivot), target)
                self._advance(cursors, near, min(target, max(beyond, pivot + 1)))
                continue
            if near[0][0] == pivot:
                score = sum(self.lists[t][1][at] for _, at, t in near)
                if score >= self.needed[pivot]:
                    found.append((pivot, float(score)))
                self._advance(cursors, near, pivot + 1)
            else:
                self._advance(cursors, near, pivot)
        return found

    def _advance(self, cursors: list, some: list, target: int) -> None:
        """Move the cursors to the first item from ``target`` on, and drop those at their end."""
        for c in some:
            items = self.lists[c[2]][0]
            at = c[1]
            while at < len(items) and items[at] < target:
                at += 1
            c[1] = at
            c[0] = items[at] if at < len(items) else -1
        cursors[:] = [c for c in cursors if c[0] >= 0]

    def best(self, number: int, passage: list[bytes]) -> tuple[float, int]:
        """(overlap, first word) of the passage within these words that has most of an item.

        The overlap is the lesser of the parts of the question's shingles and of the answer's words. An
        item shorter than a shingle is one shingle.
        """
        question, answer, span = self.questions[number], self.answers[number], self.spans[self.ids[number]]
        size = min(SHINGLE, min(s.count(b" ") for s in question) + 1)
        runs = (b" ".join(passage[i : i + size]) for i in range(len(passage) - size + 1))
        marks = [(i, i + size, 0, run) for i, run in enumerate(runs) if run in question]
        marks += [(i, i + 1, 1, w) for i, w in enumerate(passage) if w in answer]
        marks.sort()

        def part(some: list) -> float:
            found = [len({m[3] for m in some if m[2] == kind}) for kind in (0, 1)]
            return min(found[0] / len(question), found[1] / len(answer) if answer else 1.0)

        most = (part(marks), 0)
        if most[0] < self.overlap - 1e-9:
            return most  # even all of the window is not enough
        return max(
            ((part([m for m in marks[k:] if m[1] <= start + span]), -start) for k, (start, *_) in enumerate(marks)
             if k == 0 or marks[k - 1][0] < start), default=(0.0, 0),
        )

    def search(self, found: list[bytes], terms: np.ndarray) -> dict[int, tuple[float, int, float]]:
        """item id: (overlap, first word negative, score) of the items these words hold, each where it has most of it."""
        hits: dict[int, tuple[float, int, float]] = {}
        for window, own in self.windows(terms):
            at = window * self.stride
            passage = None
            for number, score in self.retrieve(own.tolist()):
                if passage is None:
                    passage = found[at : at + 2 * self.stride]
                part, start = self.best(number, passage)
                if part >= self.overlap - 1e-9:
                    hit = (part, start - at, score)
                    hits[self.ids[number]] = max(hits.get(self.ids[number], hit), hit)
        return hits


class Shelf:
    """An index for the items of every length from a power of two to the next."""

    def __init__(self, items: list[tuple[int, str]], overlap: float = OVERLAP):
        by_length: dict[int, list[tuple[int, str]]] = {}
        for item in items:
            by_length.setdefault(len(words(item[1])).bit_length() // 2, []).append(item)
        self.indexes = [i for i in (Index(some, overlap) for _, some in sorted(by_length.items())) if i.ids]
        self.terms = {w: n for n, w in enumerate(sorted({w for i in self.indexes for w in i.terms}))}
        self.own = []  # of every index: its terms by the shelf's, and -1 at the end for words of no item
        for index in self.indexes:
            table = np.full(len(self.terms) + 1, -1, dtype=np.int64)
            for w, t in index.terms.items():
                table[self.terms[w]] = t
            self.own.append(table)

    def search(self, text: str) -> dict[int, tuple[float, float, int]]:
        """item id: (overlap, score, first word) of the items a text holds."""
        found, hits = words(text), {}
        get = self.terms.get
        terms = np.array([get(w, -1) for w in found], dtype=np.int64)
        for index, table in zip(self.indexes, self.own):
            hits |= {i: (part, score, -start) for i, (part, start, score) in index.search(found, table[terms]).items()}
        return hits


def _searched(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for batch in batches:
            rows = [
                (doc, digest, item, *hit)
                for doc, digest, text in zip(batch["_id"], batch["digest"], batch["_text"])
                for item, hit in index.search(text).items()
            ]
            yield pd.DataFrame(rows, columns=["_id", "digest", "item_id", "overlap", "score", "passage"])
    return run


def leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", row_id: str = "doc_id", item_id: str = "item_id",
    item_text: str = "text", overlap: float = OVERLAP, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(``row_id``, digest, item_id, overlap, score, passage): every item that a text holds.

    A text holds an item if a passage of STRETCH times the item's words has at least ``overlap`` of the
    shingles of five words of the item's question and as much of the words of its answer. ``digest``
    is xxhash64 of the text, ``passage`` the word, from 0, at which the best passage begins (the first of
    several). Items shorter than a shingle must stand whole; empty and NULL items, and items with a NULL id,
    are in no text. NULL and empty texts hold nothing, NULL ids stay NULL, repeated rows give repeated
    results. Texts are read whole. Without items or without texts the result is empty.
    """
    spark = docs.sparkSession
    whole = docs.select(
        F.col(row_id).cast("string").alias("_id"), F.xxhash64(common.whole(text)).alias("digest"), common.whole(text).alias("_text")
    )
    tests = items.select(F.col(item_id).cast("bigint").alias("i"), common.whole(item_text).alias("t")).filter("i is not null")
    size = tests.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    found = []
    for part in range(parts):
        rows = tests.filter(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).orderBy("i", "t").collect()
        shared = spark.sparkContext.broadcast(Shelf([(r["i"], r["t"]) for r in rows], overlap))
        schema = "_id string, digest bigint, item_id bigint, overlap double, score double, passage bigint"
        found.append(common.stored(whole.mapInPandas(_searched(shared), schema), "leaks"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.select(F.col("_id").cast("bigint").alias(row_id), "digest", "item_id", "overlap", "score", "passage")


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item.

    NULL, empty and very long texts, ties, repeated rows and empty tables are as in ``leaks``: rows that hold
    nothing stay, equal rows go or stay together.
    """
    return common.without(docs, leaks(docs, items, text, row_id).select(row_id, "digest").distinct(), row_id, text)


@query("op4_decontaminate")
def op4_decontaminate(spark, sf):
    found = leaks(common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark"))
    return found.drop("digest")
