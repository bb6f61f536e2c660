"""Toxicity by class-conditional Kneser-Ney models of words.

Two models spell words, one counted on toxic and one on ordinary labelled texts: each gives the next
character of a word, or its end, after all of the word so far. Both interpolate with the same
pooled model, which backs off, a character less at a time, to the last ``BACKOFF`` to 0 characters before
and at last to a uniform share; there a character counts as often as there are different longer
histories that it has followed. So an expression that is rare in either class takes its probability from
what words like it have in common. A word's gain is the difference of its two log-likelihoods, over all of its
characters: what only ordinary texts have speaks against, what one toxic text has speaks for. The first
character that neither class has counted tells what the two models keep for such ones, the characters after it tell
nothing, as both models then are the pooled one. So inflected forms that were never counted share what their stem says.

A text is scored by its gain per word: over the whole text, and over the sixtieth of its words with the
largest gains, which keeps a few words from drowning in a long text. A logistic function of the two,
fitted on labelled rows that the models have not seen, maps them to 0..1.

Counts are of texts (a word counts once in each), keyed by the spelled characters themselves and joined
in Spark; they and the table of gains grow with the labelled texts. Texts are read once: the gains of the words that
most of the counted texts have, at most ``PART``, are broadcast, and a text's other words leave the task, each
with how often it stands. These words are spelled once each, whatever the number of texts, where the part of the table is
that they begin like (at most ``PART`` entries), and their gains are joined to the texts again. So the table and the
words may have any size, and no result depends on which words are broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

#: Characters of a word that are spelled: a longer run of letters is cut into words of so many.
LONGEST = 24
#: Scripts that put no space between words are taken two characters at a time.
WORD = re.compile("[^\\W\u2e80-\ud7ff\U00020000-\U0003ffff]{1,%d}|[\u2e80-\ud7ff\U00020000-\U0003ffff]{1,2}" % LONGEST)
#: What stands for the end of a word.
END = "\n"
#: Toxic texts that a beginning of a word must stand in to have a gain: none, ``gains`` leaves nothing out.
LEAST = 0
#: The longest shortened history, and what stands before a word's first character in it.
BACKOFF, START = 4, "\t"
#: The most telling words of a text: one in so many, and at least so many.
SHARE, FEWEST = 60, 3
#: Entries of the table sent to a task at once, and the characters that decide an entry's part (more if a part gets too large).
PART, BEGINNING = 500_000, 3
#: Words held in a task before their beginnings are sent on, words whose gain a worker remembers.
HELD, REMEMBERED = 50_000, 500_000
#: Labelled rows that the logistic function is fitted on, at most.
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3
HELD_OUT, CALIBRATION = 2, 3
FEATURES = ["whole", "worst"]
#: Units in which the logistic function takes them.
SCALES = {"whole": 10.0, "worst": 1.0}


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def beginnings(word: str) -> list[str]:
    """What a word is spelled through: its first character, its first two, ..., and its end."""
    ended = word + END
    return [ended[: k + 1] for k in range(len(ended))]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pd.DataFrame:
        sums: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for counts, own in zip(found, sums):
            for word, n in counts.items():
                for gram in beginnings(word):
                    own[gram] = own.get(gram, 0) + n
            counts.clear()
        grams = list(sums[0].keys() | sums[1].keys())
        return pd.DataFrame({"gram": pd.Series(grams, dtype=object), "ordinary": [sums[0].get(g, 0) for g in grams], "toxic": [sums[1].get(g, 0) for g in grams]})

    for batch in batches:
        for text, toxic in zip(batch["_text"], batch["toxic"]):
            found[int(toxic)].update(set(words(text)))
            if len(found[0]) + len(found[1]) > HELD:
                yield rows()
    yield rows()


def discounts(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, by how many counts are 1 to 4 (Chen and Goodman 1998)."""
    if not (n1 and n2 and n3):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), i + 0.95) for i, d in enumerate(found)]


def _counted(rows: DataFrame, kinds: list[str]):
    """What is cut from the counts in the columns ``kinds``, and the number of rows."""
    often = rows.agg(*[F.count_if(F.col(k) == i).alias(f"{k}{i}") for k in kinds for i in (1, 2, 3, 4)], F.count("*").alias("n")).first()

    def cut(k: str) -> Column:
        d = discounts(*[float(often[f"{k}{i}"]) for i in (1, 2, 3, 4)])
        return F.when(F.col(k) >= 3, d[2]).when(F.col(k) == 2, d[1]).when(F.col(k) == 1, d[0]).otherwise(0.0)

    return cut, often["n"]


def shared(rows: DataFrame, longest: int) -> DataFrame:
    """(after, last, share): the shared model's probability of ``last`` after the shortened histories of ``rows`` (history, last).

    A history is shortened to its last ``longest`` characters, then to one less at a time (a word's start counts as
    a character, which only longer histories have). The count of a character after a shortened history is
    the number of different histories, one step longer, that end in it and that the character has followed.
    """
    levels = [rows.select(F.concat(F.lit(START), "history").alias("before"), "last", (F.char_length("history") >= longest).alias("longer"))]
    for k in range(longest, -1, -1):
        cut_short = levels[-1].groupBy(F.right("before", F.lit(k)).alias("before"), "last").agg(F.count_if("longer").alias("n"))
        levels.append(common.stored(cut_short.withColumn("longer", F.char_length("before") == k), "toxicity-histories"))
    made: list[DataFrame] = []
    for k, level in enumerate(reversed(levels[1:])):
        seen = level.filter("n > 0").select(F.col("before").alias("after"), "last", "n")
        cut, several = _counted(seen, ["n"])
        totals = seen.groupBy("after").agg(F.sum("n").alias("of"), F.sum(cut("n")).alias("left"))
        if made:
            below = made[-1].select(F.col("after").alias("_less"), "last", F.col("share").alias("_share"))
            seen = seen.withColumn("_less", F.right("after", F.lit(k - 1))).join(below, ["_less", "last"])
        else:
            seen = seen.withColumn("_share", F.lit(1 / max(several, 1)))
        share = (F.col("n") - cut("n") + F.col("left") * F.col("_share")) / F.col("of")
        made.append(common.stored(seen.join(totals, "after").select("after", "last", share.alias("share")), "toxicity-shared"))
    return reduce(DataFrame.union, made)


def gains(counts: DataFrame, longest: int | None = None) -> DataFrame:
    """(gram, n, gain, other) of every beginning of ``counts`` (gram, ordinary, toxic), whichever class has it; n: texts of both.

    gain = log p(last character | toxic) - log p(last character | ordinary), after what comes before it. The
    pooled model backs off to ``shared`` histories of at most ``longest`` characters; without it, to the
    share of histories that the character has followed. ``other`` is the gain of a character that neither class has
    there: a model then gives the pooled probability times what it has cut from its counts, all of it if it has none.
    """
    kinds = {"o": F.col("ordinary"), "t": F.col("toxic"), "p": F.col("ordinary") + F.col("toxic")}
    rows = counts.select(
        "gram", F.substring("gram", 1, F.char_length("gram") - 1).alias("history"), F.right("gram", F.lit(1)).alias("last"),
        *[c.alias(k) for k, c in kinds.items()],
    )
    cut, n = _counted(rows, list(kinds))
    if longest is None:
        followed = rows.groupBy("last").agg((F.count("*") / F.lit(max(n, 1))).alias("share"))
        known = rows.join(followed, "last")
    else:
        known = rows.withColumn("after", F.right("history", F.lit(longest))).join(shared(rows, longest), ["after", "last"])
    siblings = Window.partitionBy("history")
    known = known.select("gram", *kinds, "share", *[F.sum(k).over(siblings).alias(f"n_{k}") for k in kinds],
                         *[F.sum(cut(k)).over(siblings).alias(f"cut_{k}") for k in kinds])
    pooled = (F.col("p") - cut("p") + F.col("cut_p") * F.col("share")) / F.col("n_p")

    def likely(k: str) -> Column:
        own = (F.col(k) - cut(k) + F.col(f"cut_{k}") * pooled) / F.col(f"n_{k}")
        return F.when(F.col(f"n_{k}") > 0, own).otherwise(pooled)

    def left(k: str) -> Column:
        return F.when(F.col(f"n_{k}") > 0, F.log(F.col(f"cut_{k}") / F.col(f"n_{k}"))).otherwise(0.0)

    gain = F.log(likely("t")) - F.log(likely("o"))
    return known.select("gram", F.col("p").alias("n"), gain.alias("gain"), (left("t") - left("o")).alias("other"))


def parts_of(table: DataFrame, most: int) -> Iterator[dict[str, float]]:
    """The table (gram, gain) in parts of at most ``most`` entries.

    What a word is spelled through is in one of them; entries shorter than a beginning are in all.
    """
    short = F.char_length("gram") < BEGINNING
    parts, before = 1, None
    while True:
        part = F.pmod(F.xxhash64(F.left("gram", F.lit(BEGINNING))), F.lit(parts))
        sizes = table.groupBy(F.when(short, -1).otherwise(part).alias("part")).agg(F.count("*").alias("n")).groupBy().agg(
            F.max(F.when(F.col("part") >= 0, F.col("n"))).alias("large"), F.max(F.when(F.col("part") < 0, F.col("n"))).alias("short")
        ).first()
        large = sizes["large"] or 0
        if large + (sizes["short"] or 0) <= most or large == before:
            break  # small enough, or one beginning's entries, which are not cut
        parts, before = parts * 2, large
    for i in range(parts):
        rows = table.filter(short | (part == i)).toPandas()
        yield dict(zip(rows["gram"].tolist(), rows["gain"].tolist()))


class Gains:
    """Words to gains by one of ``parts`` parts of the table: those of the words that are spelled through it."""

    def __init__(self, table: dict[str, float], part: int, parts: int, beyond: dict[str, float] | None = None):
        self.table, self.part, self.parts, self.beyond = table, part, parts, beyond or {}
        self.known: dict[str, float | None] = {}

    def of(self, word: str) -> float | None:
        """The gain, with what lies beyond if the table has no entry; None for another part's word."""
        if word not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[word] = self._spelled(word)
        return self.known[word]

    def _spelled(self, word: str) -> float | None:
        if self.parts > 1 and xxhash.xxh64_intdigest((word + END)[:BEGINNING].encode("utf-8", "surrogatepass"), 42) % self.parts != self.part:
            return None
        total, before = 0.0, ""
        for gram in beginnings(word):
            gain = self.table.get(gram)
            if gain is None:
                return total + self.beyond.get(before, 0.0)
            total += gain
            before = gram
        return total


def _cut(long: Column, table: DataFrame, words_: DataFrame, most: int) -> tuple[int, int]:
    """Characters and number of parts, a power of two, by which no part has more than ``most`` entries, nor more words."""
    length = BEGINNING
    while True:
        begin = F.left(long, F.lit(length)).alias("begin")
        own = table.select(F.col("gram").alias("long")).filter(F.char_length("long") >= length).select(begin, F.lit(1).alias("entry"), F.lit(0).alias("word"))
        sizes = own.union(words_.select(F.concat("word", F.lit(END)).alias("long")).select(begin, F.lit(0), F.lit(1)))
        sizes = common.stored(sizes.groupBy("begin").agg(F.sum("entry").alias("entry"), F.sum("word").alias("word")), "toxicity-sizes")
        top = sizes.agg(F.max(F.greatest("entry", "word")).alias("one"), F.greatest(F.sum("entry"), F.sum("word")).alias("all")).first()
        if (top["one"] or 0) <= most or length > LONGEST:
            break
        length += 1
    parts = 1
    while parts * most < (top["all"] or 0):
        parts *= 2
    while parts > 1:
        part = F.pmod(F.xxhash64("begin"), F.lit(parts))
        sums = sizes.groupBy(part).agg(F.greatest(F.sum("entry"), F.sum("word")).alias("n")).agg(F.max("n").alias("n")).first()
        if sums["n"] <= max(most, top["one"]) or parts >= 4 * top["all"]:
            break
        parts *= 2
    return length, parts


def _spelled_part(table: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
    if own.empty:
        return pd.DataFrame({"word": pd.Series(dtype=object), "gain": pd.Series(dtype=float)})
    grams, known, other = table["gram"].tolist(), table["gain"].notna().tolist(), table["other"].tolist()
    gain = {g: x for g, x, k in zip(grams, table["gain"].tolist(), known) if k}
    beyond = {g[:-1] if k else g: x for g, x, k in zip(grams, other, known) if x == x}
    part = Gains(gain, 0, 1, beyond)
    return pd.DataFrame({"word": own["word"], "gain": pd.Series([part.of(w) for w in own["word"]], dtype=float)})


def spelled(words_: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """(word, gain) of ``words_`` (word, each once), spelled through ``table`` (gram, gain, other).

    Words and entries meet in parts by how they begin; entries that are shorter than that go where a word needs them,
    and so does, as a row without a gain, what follows such a beginning in neither class.
    """
    long = F.col("long")
    length, parts = _cut(long, table, words_, most)
    part = F.pmod(F.xxhash64(F.left(long, F.lit(length))), F.lit(parts)).alias("part")
    dealt = words_.select("word", F.concat("word", F.lit(END)).alias("long")).select("word", "long", part)
    entry = ["part", "gram", "gain", "other"]
    entries = table.filter(F.char_length("gram") >= length).withColumn("long", F.col("gram")).select("*", part).select(*entry)
    short = table.filter(F.char_length("gram") < length).select("gram", "gain", F.lit(None).cast("double").alias("other"))
    after = table.filter(F.char_length("gram") <= length).groupBy(F.substring("gram", 1, F.char_length("gram") - 1).alias("gram")).agg(
        F.lit(None).cast("double").alias("gain"), F.max("other").alias("other")
    )
    ends = F.sequence(F.lit(0), F.least(F.char_length("long"), F.lit(length - 1)))
    needed = dealt.select("part", F.explode(F.transform(ends, lambda k: F.left(long, k))).alias("gram")).distinct()
    entries = entries.union(needed.join(short.union(after), "gram").select(*entry))
    return entries.groupBy("part").cogroup(dealt.select("part", "word").groupBy("part")).applyInPandas(_spelled_part, "word string, gain double")


def _measured(shared, unknown: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, gains_ = shared.value
        get, row = dict(zip(known.split(END), gains_.tolist())).get, TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for text in batch["_text"]:
                found = words(text)
                own = np.fromiter(map(get, found, repeat(unknown)), dtype=float, count=len(found))
                other = np.flatnonzero(np.isnan(own))
                rest: Counter = Counter()
                if len(other):
                    rest.update([found[i] for i in other])
                    own = own[~np.isnan(own)]
                k = share_of(len(found))
                most = np.partition(own, len(own) - k)[len(own) - k :] if len(own) > k else own
                rows.append((row, len(found), float(own.sum()), most, list(rest), list(rest.values())))
                row += 1
            made = pd.DataFrame(rows, columns=["row", "n", "total", "most", "word", "times"])
            yield made.assign(doc_id=batch["_id"].to_numpy())[["row", "doc_id", *made.columns[1:]]]
    return run


def share_of(n: int) -> int:
    """How many of a text's ``n`` words are looked at for the largest gains."""
    return min(n, max(FEWEST, n // SHARE))


def frequent(table: DataFrame, most: int) -> DataFrame:
    """The entries of ``table`` (gram, n) in the largest numbers of texts, by powers of two, that end at most ``most`` words.

    A word's beginnings are in no fewer texts than the word, so they are there with it.
    """
    bits, ended = F.length(F.bin("n")), F.endswith("gram", F.lit(END))
    least, held = 65, 0
    for r in sorted(table.filter(ended).groupBy(bits.alias("bits")).count().collect(), key=lambda r: -r["bits"]):
        held += r["count"]
        if held > most:
            break
        least = r["bits"]
    return table.filter(bits >= least)


def measures(whole: DataFrame, table: DataFrame, part_size: int) -> DataFrame:
    """(doc_id, *FEATURES) for each row of ``whole`` (_id, _text), by ``table`` (gram, n, gain, other)."""
    spark = whole.sparkSession
    often = frequent(table, part_size)
    ended = often.filter(F.endswith("gram", F.lit(END))).select(F.substring("gram", 1, F.char_length("gram") - 1).alias("word"))
    known = common.stored(spelled(ended, often, part_size), "toxicity-frequent")
    part = next(parts_of(known.withColumnRenamed("word", "gram"), part_size))
    # as one text and one array: a dictionary takes several times the memory while it is sent
    shared = spark.sparkContext.broadcast((END.join(part), np.fromiter(part.values(), dtype=float, count=len(part))))
    del part
    unknown = 0.0 if table.isEmpty() else float("nan")  # without counts no word has a gain
    named = "row bigint, doc_id string, n bigint, total double, most array<double>, word array<string>, times array<bigint>"
    rows = common.stored(whole.select("_id", "_text").mapInPandas(_measured(shared, unknown), named), "toxicity-part")
    k = F.least(F.col("n"), F.greatest(F.lit(FEWEST), F.floor(F.col("n") / SHARE))).cast("int")
    rest = rows.select("row", k.alias("k"), F.inline(F.arrays_zip("word", "times")))
    others = common.stored(rest.select("word").distinct(), "toxicity-words")
    more = rest.join(common.stored(spelled(others, table, part_size), "toxicity-spelled"), "word").groupBy("row").agg(
        F.sum(F.col("gain") * F.col("times")).alias("more"),
        F.flatten(F.collect_list(F.array_repeat("gain", F.least("times", "k").cast("int")))).alias("also"),
    )
    merged = rows.drop("word", "times").join(more, "row", "left")
    merged = common.stored(merged.select(
        "doc_id", "n", (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
        F.slice(F.sort_array(F.concat("most", F.coalesce("also", F.array().cast("array<double>"))), asc=False), F.lit(1), k).alias("most"), k.alias("k"),
    ), "toxicity-measures")
    mean = F.aggregate("most", F.lit(0.0), lambda a, x: a + x) / F.col("k")
    return merged.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(F.col("n") > 0, F.col("total") / F.col("n")).otherwise(0.0).alias("whole"),
        F.when(F.col("n") > 0, mean).otherwise(0.0).alias("worst"),
    )


def _logistic(rows: list) -> np.ndarray:
    """Offset and two weights by Newton's method; without both classes a prior of no toxicity."""
    y = np.array([r["toxic"] for r in rows], dtype=float)
    if len(set(y.tolist())) < 2:
        return np.array([-4.0, 0.0, 0.0])
    x = np.array([[1.0] + [SCALES[f] * r[f] for f in FEATURES] for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.01 * w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w)), slope)
        w += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return w


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", row_id: str = "doc_id",
    threshold: float = THRESHOLD, calibration_rows: int = CALIBRATION_ROWS, part_size: int = PART,
) -> DataFrame:
    """(``row_id``, held_out, score, predicted) for each row of ``docs``; ``row_id`` is a bigint.

    ``labels`` has ``row_id`` and toxic (0/1); of several labels the largest counts, NULLs do not.
    Rows fall into folds by crc32(id as text) mod 4: 0 and 1 are counted, 3 fits the logistic
    function (at most ``calibration_rows`` of them, by a hash of the id), 2 is held out from both.
    Nothing but the text enters a score. NULL and empty texts, and those without a letter or digit, measure 0
    and get the score of that; NULL ids are never labelled and not held out; repeated ids are scored
    row by row. Without labelled rows of both classes every score is low and equal. Whole texts are
    counted and scored, whatever their length; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    whole = docs.select(F.col(row_id).cast("bigint").alias("doc_id"), common.whole(text).alias("_text"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    known = (
        labels.select(F.col(row_id).cast("bigint").alias("doc_id"), "toxic").filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")).withColumn("_fold", fold)
    )
    training = whole.join(common.sized(known.filter(F.col("_fold") < 2)), "doc_id").select("_text", "toxic")
    with common.arrow_rows(spark, 512):
        counted = training.mapInPandas(_counts, "gram string, ordinary bigint, toxic bigint")
        counts = common.stored(
            counted.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "toxicity-counts"
        )
    table = common.stored(gains(counts, BACKOFF), "toxicity-gains")
    rows = whole.select(F.col("doc_id").cast("string").alias("_id"), "_text")
    measured = measures(rows, table, part_size)
    fitted = measured.join(known.filter(F.col("_fold") == CALIBRATION), "doc_id")
    sample = fitted.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(calibration_rows).select("toxic", *FEATURES).collect()
    w = [float(v) for v in _logistic(sample)]
    z = F.lit(w[0])
    for name, weight in zip(FEATURES, w[1:]):
        z = z + SCALES[name] * weight * F.col(name)
    likely = 1 / (1 + F.exp(-z))
    return measured.select(
        F.col("doc_id").alias(row_id), F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        likely.alias("score"), F.when(likely >= threshold, 1).otherwise(0).alias("predicted"),
    )


@query("op5_toxicity")
def op5_toxicity(spark, sf):
    return score(common.table(spark, sf, "documents"), common.table(spark, sf, "labels"))
