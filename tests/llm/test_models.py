"""Language models, decontamination, mixing and the pipeline."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import common, decontaminate, mixing, quality, toxicity

DOCS, SF = "doc_id bigint, text string, lang string", "/root/testdata/sf0.001"


# --- quality ---------------------------------------------------------------------------------

def plain_perplexity(trusted, texts):
    """Interpolated modified Kneser-Ney over characters, straight from the definition."""
    tri = Counter()
    for t in trusted:
        s = ["<", "<", *t, ">"]
        tri.update(zip(s, s[1:], s[2:]))
    two = Counter((b, c) for _, b, c in tri)
    one = Counter(c for _, c in two)

    def discounts(counts):
        n = Counter(counts.values())
        if not (n[1] and n[2] and n[3]):
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [min(max(x, 0.1), i + 0.95) for i, x in enumerate(d)]

    def level(counts):
        d, total, cut = discounts(counts), Counter(), Counter()
        for key, n in counts.items():
            total[key[:-1]] += n
            cut[key[:-1]] += d[min(n, 3) - 1]
        return d, total, cut

    levels = [level({(c,): n for c, n in one.items()}), level(two), level(tri)]
    tables = [{(c,): n for c, n in one.items()}, two, tri]

    def p(key, order):
        if order < 0:
            return 1 / (len(one) + 1)
        d, total, cut = levels[order]
        low, context = p(key[1:], order - 1), key[:-1]
        if not total[context]:
            return low
        n = tables[order].get(key, 0)
        return (n - (d[min(n, 3) - 1] if n else 0)) / total[context] + cut[context] / total[context] * low

    out = []
    for t in texts:
        s = ["<", "<", *t, ">"]
        out.append(math.exp(-sum(math.log(p(k, 2)) for k in zip(s, s[1:], s[2:])) / (len(t) + 1)))
    return out


def test_perplexity_equals_the_definition(spark, prose):
    trusted = [prose(40, i) for i in range(25)]
    texts = [prose(30, 100 + i) for i in range(5)] + ["", "中文 字符", "QQQ!! ###", trusted[0], "a"]
    rows = spark.createDataFrame([(str(i), "en", str(i), t) for i, t in enumerate(texts)], "_id string, _lang string, _digest string, _text string")
    found = quality.perplexities(rows, spark.createDataFrame([(t,) for t in trusted], "_text string"))
    got = {int(r._id): (r.n_grams, r.perplexity) for r in found.collect()}
    for i, (text, want) in enumerate(zip(texts, plain_perplexity(trusted, texts))):
        assert got[i][0] == len(text) + 1
        assert got[i][1] == pytest.approx(want, rel=1e-4)


def test_junk_goes_and_clean_texts_stay(spark, prose, odd):
    rows = [(i, prose(120, i), "en") for i in range(300)] + [(1000 + i, prose(80, i).upper().replace(" ", "$$$ "), "en") for i in range(60)]
    labels = [(i, 1) for i in range(300)] + [(1000 + i, 0) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("digest", F.lit("x"))
    kept = quality.keep_good(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & set(range(300))) >= 297 and not ids & set(range(1000, 1060))


def test_a_rare_language_has_its_own_threshold(spark, prose):
    rows = [(i, prose(120, i), "en") for i in range(300)] + [(1000 + i, "la lo le " * (30 + i), "xx") for i in range(60)] + [(2000, prose(120, 9), "yy")]
    labels = [(i, 1) for i, *_ in rows if i < 2000]
    found = quality.judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    held = {r.doc_id: r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == quality.HELD_OUT and r.doc_id < 2000}
    limits = {r.lang: r.threshold / math.exp(quality.SLACK / math.sqrt(r.n_grams)) for r in found}
    few = [r.perplexity for r in held.values() if r.lang == "xx"]
    assert 0 < len(few) < 30
    assert limits["xx"] == pytest.approx(quality.MARGIN * max(few)) and limits["xx"] < 0.7 * limits["en"]
    assert limits["yy"] == pytest.approx(limits["en"], rel=0.05)


def test_odd_rows_and_no_labels(spark, odd):
    none = spark.createDataFrame([(None, 1), (7, None)], "doc_id bigint, quality int")
    judged = quality.judge(odd, none).collect()
    assert len(judged) == odd.count()
    assert all(r.kept == (r.n_grams > 1) for r in judged)
    kept = quality.keep_good(odd, none)
    assert kept.columns == odd.columns and kept.count() == odd.filter("text is not null and text <> ''").count()
    assert quality.judge(odd.limit(0), none).collect() == []


# --- toxicity --------------------------------------------------------------------------------

def test_held_out_texts_are_told_apart(spark, prose):
    rng, rows, labels = random.Random(1), [], []
    for i in range(1200):
        words = prose(60 if i % 7 else 400, i).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["xyzzyq", "qwruvx", "zzkwyv"]) + rng.choice(["", "er", "on"]))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(toxic)))
    found = toxicity.score(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in found if r.held_out]
    assert 200 < len(held) < 400
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_only_training_labels_matter(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.score(documents, x).collect()} for x in (labels, flipped))
    assert a == b


def test_odd_texts_get_a_score(spark, odd):
    none = spark.createDataFrame([(None, 1), (7, None)], "doc_id bigint, toxic int")
    found = toxicity.score(odd, none).collect()
    assert len(found) == odd.count() and all(r.score < 0.3 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert toxicity.score(odd.limit(0), none).collect() == []


def plain_gains(rows):
    """(gram -> gain) from the definition, over (text, toxic)."""
    counts = {k: defaultdict(int) for k in "otp"}
    for text, toxic in rows:
        for word in set(toxicity.WORD.findall(text.lower())):
            for k in range(1, len(word) + 2):
                for kind in ("t" if toxic else "o", "p"):
                    counts[kind][(word + toxicity.END)[:k]] += 1
    grams = counts["p"]
    d = {}
    for kind, c in counts.items():
        d[kind] = [0.0, *toxicity.discounts(*[float(sum(1 for g in grams if c[g] == i)) for i in (1, 2, 3, 4)])]
    ends, children = defaultdict(int), defaultdict(list)
    for g in grams:
        ends[g[-1]] += 1
        children[g[:-1]].append(g)

    def likely(kind, g):
        share = ends[g[-1]] / len(grams) if kind == "p" else likely("p", g)
        total = sum(counts[kind][x] for x in children[g[:-1]])
        if not total:
            return share
        cut = sum(d[kind][min(counts[kind][x], 3)] for x in children[g[:-1]])
        return (counts[kind][g] - d[kind][min(counts[kind][g], 3)] + cut * share) / total

    for h in list(children)[:40]:  # each level is a distribution, but for characters that never followed
        for kind in "otp":
            assert sum(likely(kind, g) for g in children[h]) <= 1 + 1e-9
    return {g: math.log(likely("t", g)) - math.log(likely("o", g)) for g in grams if counts["t"][g] >= toxicity.LEAST}


def toxic_rows(prose, n=240):
    rng, rows = random.Random(4), []
    for i in range(n):
        words = prose(40 if i % 5 else 300, i).split()
        if i % 4 == 0:
            words += [rng.choice(["xyzzyq", "qwrüvx", "zzkwyv"]) + rng.choice(["", "er", "on", "ish"]) for _ in range(4)]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def test_gains_and_scores_follow_the_definition(spark, prose):
    rows = toxic_rows(prose)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    crc = {r[0]: zlib.crc32(str(r[0]).encode()) % 4 for r in rows}
    table = plain_gains([r[1:] for r in rows if crc[r[0]] < 2])
    counts = spark.createDataFrame(
        [g for b in toxicity._counts(iter([pd.DataFrame([r[1:] for r in rows if crc[r[0]] < 2], columns=["_text", "toxic"])])) for g in b.itertuples(index=False)],
        "gram string, ordinary bigint, toxic bigint",
    )
    gains = common.stored(toxicity.gains(common.stored(counts, "test-counts")), "test-gains")
    got = {r.gram: r.gain for r in gains.collect()}
    assert got.keys() == table.keys() and all(abs(got[g] - table[g]) < 1e-9 for g in table)
    whole = docs.select(F.col("doc_id").cast("string").alias("_id"), F.xxhash64("text").alias("digest"), F.col("text").alias("_text"))
    for part_size in (10**9, len(table) // 2):  # one part, and several
        found = {r.doc_id: r for r in toxicity.measures(whole, gains, part_size).collect()}
        for i, text, _ in rows:
            each = []
            for word in toxicity.words(text):
                gain = 0.0
                for k in range(1, len(word) + 2):
                    if (word + toxicity.END)[:k] not in table:
                        break
                    gain += table[(word + toxicity.END)[:k]]
                each.append(gain)
            k = max(toxicity.FEWEST, len(each) // toxicity.SHARE)
            assert abs(found[i].whole - sum(each) / len(each)) < 1e-9
            assert abs(found[i].worst - sum(sorted(each)[-k:]) / k) < 1e-9
    a, b = ({r.doc_id: round(r.score, 9) for r in toxicity.score(docs, labels, part_size=p).collect()} for p in (10**9, len(table) // 2))
    assert a == b


def test_shared_model_backs_off_through_shorter_histories(spark, prose):
    """Against the recursion over sets of histories; after every history the characters' shares sum to 1."""
    longest, grams = 3, {b for _, t, _ in toxic_rows(prose, 60) for w in toxicity.words(t) for b in toxicity.beginnings(w)}
    longer, counts, d = {(toxicity.START + g[:-1], g[-1]) for g in grams}, [], []
    for k in range(longest, -1, -1):
        level = defaultdict(int)
        for h, c in longer:
            if len(h) > k:
                level[h[len(h) - k :], c] += 1
        counts.insert(0, level)
        d.insert(0, [0.0, *toxicity.discounts(*[float(sum(n == i for n in level.values())) for i in (1, 2, 3, 4)])])
        longer = {(h[-k:] if k else "", c) for h, c in longer}
    symbols = {c for _, c in counts[0]}

    def share(h, c, k):
        if k < 0:
            return 1 / len(symbols)
        own = {x: counts[k][h, x] for x in symbols if (h, x) in counts[k]}
        left = sum(d[k][min(n, 3)] for n in own.values())
        return (own.get(c, 0) - d[k][min(own.get(c, 0), 3)] + left * share(h[1:], c, k - 1)) / sum(own.values())

    rows = spark.createDataFrame([(g[:-1], g[-1]) for g in grams], "history string, last string")
    got = {(r.after, r["last"]): r.share for r in toxicity.shared(rows, longest).collect()}
    assert got.keys() == {x for level in counts for x in level} and {len(h) for h, _ in got} == {0, 1, 2, 3}
    assert all(abs(v - share(h, c, len(h))) < 1e-9 for (h, c), v in got.items())
    for h in list(dict.fromkeys(h for h, _ in got))[:50]:
        assert abs(sum(share(h, c, len(h)) for c in symbols) - 1) < 1e-9


def plain_likelihoods(rows, longest):
    """(words -> gain) from the definition: the difference of a word's log-likelihoods, whatever was counted of it."""
    counts = {k: Counter() for k in "otp"}
    for text, toxic in rows:
        for word in set(toxicity.words(text)):
            for kind in ("t" if toxic else "o", "p"):
                counts[kind].update(toxicity.beginnings(word))
    levels, longer = [], {(toxicity.START + g[:-1], g[-1]) for g in counts["p"]}
    for k in range(longest, -1, -1):
        levels.insert(0, Counter((h[len(h) - k :], c) for h, c in longer if len(h) > k))
        longer = {(h[-k:] if k else "", c) for h, c in longer}

    def cut(table, several):
        d = [0.0, *toxicity.discounts(*[float(sum(1 for g in several if table[g] == i)) for i in (1, 2, 3, 4)])]
        return lambda n: d[min(n, 3)]

    def level(own, cut, key, low):
        total = sum(own.values())
        return (own[key] - cut(own[key]) + sum(map(cut, own.values())) * low) / total if total else low

    def share(h, c):
        table = levels[len(h)]
        own = Counter({x: n for (g, x), n in table.items() if g == h})
        return level(own, cut(table, table), c, share(h[1:], c) if h else 1 / len(levels[0]))

    def likely(kind, g):
        h = g[:-1]
        low = share(h[-longest:], g[-1]) if kind == "p" else likely("p", g)
        return level(Counter({x: counts[kind][x] for x in counts["p"] if x[:-1] == h}), cut(counts[kind], counts["p"]), g, low)

    return lambda word: sum(math.log(likely("t", g)) - math.log(likely("o", g)) for g in toxicity.beginnings(word))


def test_all_of_a_word_is_measured_whichever_class_has_it(spark):
    """Words that only ordinary texts have, that one toxic text has, and that neither has, against the definition."""
    training = [("the plain cat sat", 0), ("a plain cap is that", 0), ("the plane sat", 0), ("plain tea", 0), ("the zorg sat", 1), ("zork zorgs", 1), ("a zork", 1)]
    texts = ["the cat", "zorg", "zorks zorgling zor", "plankton plains qux", "", "Ω zürich", "teapot " * 5 + "zork the the", "plain", "capital city sits there then " * 30]
    longest, word_gain = 2, plain_likelihoods(training, 2)
    counted = pd.concat(toxicity._counts(iter([pd.DataFrame(training, columns=["_text", "toxic"])])))
    counts = common.stored(spark.createDataFrame(counted, "gram string, ordinary bigint, toxic bigint"), "test-counts")
    table = common.stored(toxicity.gains(counts, longest), "test-gains")
    gains = {r.gram for r in table.collect()}
    assert gains == {b for t, _ in training for w in toxicity.words(t) for b in toxicity.beginnings(w)}
    assert word_gain("cat") < 0 and word_gain("zorgs") > 0
    whole = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "_id string, _text string")
    for part_size in (10**9, 20, 2):  # all counted words are broadcast, some are, next to none
        found = {r.doc_id: r for r in toxicity.measures(whole, table, part_size).collect()}
        assert len(found) == len(texts)
        for i, text in enumerate(texts):
            each = [word_gain(w) for w in toxicity.words(text)]
            k = min(len(each), max(toxicity.FEWEST, len(each) // toxicity.SHARE))
            assert abs(found[i].whole - (sum(each) / len(each) if each else 0)) < 1e-9, text
            assert abs(found[i].worst - (sum(sorted(each)[-k:]) / k if each else 0)) < 1e-9, text


def test_parts_have_what_their_words_need(spark):
    table = {toxicity.beginnings(w)[k]: float(k) for w in ("abcdefgh", "abcdefxy", "abcxyz", "zzzzzzzzz", "ab") for k in range(len(w) + 1)}
    df = spark.createDataFrame(list(table.items()), "gram string, gain double")
    parts = list(toxicity.parts_of(df, 20))
    assert len(parts) > 1 and {g for p in parts for g in p} == set(table)
    for word in ("abcdefgh", "abcxyz", "zzzzzzzzz", "ab", "nothing"):
        answers = [g for g in (toxicity.Gains(p, i, len(parts)).of(word) for i, p in enumerate(parts)) if g is not None]
        assert answers == [toxicity.Gains(table, 0, 1).of(word)]


def test_toxic_texts_of_every_language_are_found(spark):
    """Held-out labelled rows of a real table: nine of ten are found in each language, one of a hundred others marked."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    found = toxicity.score(docs, labels).filter("held_out").join(labels.filter("toxic is not null"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    sums = found.groupBy("lang").agg(
        F.sum("toxic").alias("toxic"), F.sum(F.col("toxic") * F.col("predicted")).alias("caught"),
        F.sum((1 - F.col("toxic")) * F.col("predicted")).alias("marked"), F.count("*").alias("n"),
    ).collect()
    assert len(sums) == 4 and all(r.caught >= 0.9 * r.toxic for r in sums), sums
    assert sum(r.marked for r in sums) <= 0.01 * sum(r.n - r.toxic for r in sums), sums


# --- decontamination -------------------------------------------------------------------------

def plain_leaks(docs, items):
    """Every passage of twice an item's words, one after the other."""
    out = set()
    for i, item in items:
        want = decontaminate.shingles(decontaminate.words(item))
        span = 2 * len(decontaminate.words(item))
        for d, text in docs:
            found = decontaminate.words(text)
            if any(
                len(want & decontaminate.shingles(found[s : s + span])) >= 0.8 * len(want) - 1e-9
                for s in range(max(1, len(found) - span + 1))
            ):
                out.add((d, i))
    return out


@pytest.mark.parametrize("beside", [0, 120])
def test_a_stretched_item_is_found_at_every_offset(prose, beside):
    """59 words with 30 others put in, alone and beside a longer item, also when that is in another part."""
    item = prose(59, 77).split()
    stretched = " ".join(item[:29] + prose(30, 78).split() + item[29:])
    items = [(1, " ".join(item))] + ([(2, prose(beside, 79))] if beside else [])
    for index in (decontaminate.Shelf(items), decontaminate.Shelf(items[:1]), decontaminate.Index(items)):
        if isinstance(index, decontaminate.Index):  # one index for all lengths
            one, index = index, decontaminate.Shelf([])
            index.indexes, index.terms = [one], one.terms
            index.own = [np.array([*range(len(one.terms)), -1])]
        found = [index.search(f"{prose(n, 1000 + n)} {stretched} {prose(150, 5)}") for n in range(120)]
        assert all(set(f) == {1} for f in found)
        assert all(abs(f[1][2] - n) <= 30 for n, f in enumerate(found))
    apart = " ".join(item[:29] + prose(100, 78).split() + item[29:])
    assert not any(decontaminate.Shelf(items).search(f"{prose(n, 1000 + n)} {apart}") for n in range(0, 120, 7))


def test_words_of_any_script_are_separated():
    assert decontaminate.words("The “old”—Bridge, über_alles 3.5") == [w.encode() for w in ("the", "old", "bridge", "über", "alles", "3", "5")]


def test_every_leak_is_found_and_no_other(spark, prose):
    items = [(i, prose(12 + i, 500 + i)) for i in range(30)]
    docs = []
    for i in range(150):
        words, item = prose(150, i).split(), items[i % 30][1].split()
        cut = [item, item[: len(item) * 9 // 10], item[: len(item) // 2], [w.upper() + "," for w in item], []][i % 5]
        at = (i * 7) % 140
        docs.append((i, " ".join(words[:at] + cut + words[at:])))
    found = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == plain_leaks(docs, items)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found}) > 80


def test_parts_of_the_index_give_the_same(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    one, many = ({(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, items, part_bytes=n).collect()} for n in (1 << 20, 1500))
    assert one == many and one


def test_wand_retrieves_all_that_score_enough(prose):
    index = decontaminate.Index([(i, prose(20 + i % 9, i)) for i in range(120)])
    for seed in range(40):
        terms = sorted({index.terms[w] for w in decontaminate.words(prose(40, seed)) if w in index.terms})
        scores = defaultdict(float)
        for t in terms:
            for n, w in zip(*index.lists[t]):
                scores[n] += w
        want = {n: s for n, s in scores.items() if s >= index.needed[n]}
        got = dict(index.retrieve(terms))
        assert got.keys() == want.keys() and all(got[n] == pytest.approx(want[n]) for n in got)


def test_answers_must_overlap_too(spark):
    items = spark.createDataFrame([(1, "what is the name of the old bridge over the river? it is called golden arch"), (2, "one two"), (3, ""), (None, "x y z a b c")], "item_id bigint, text string")
    docs = spark.createDataFrame([
        (1, "so what is the name of the old bridge over the river nobody knows"),
        (2, "so what is the name of the old bridge over the river they said it is called golden arch here"), (3, "zero one two three"), (4, "one and two"),
    ], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == {(2, 1), (3, 2)}


def test_decontamination_of_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "a plain text of a few words"), (2, "negative id")], "item_id bigint, text string")
    clean = decontaminate.keep_clean(odd, items)
    assert clean.columns == odd.columns
    gone = {"a plain text of a few words", "A PLAIN TEXT OF A FEW WORDS", "negative id"}
    assert clean.count() == sum(r.text not in gone for r in odd.collect())
    assert decontaminate.keep_clean(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.leaks(odd.limit(0), items).collect() == []


# --- mixing ----------------------------------------------------------------------------------

def mixture(spark, prose, sizes):
    rows = [(s * 10_000 + i, prose(5 + i % 20, s * 1000 + i), f"src{s}") for s, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def sums(plan):
    found = plan.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("copies")).alias("taken"), F.first("weight").alias("w"), F.max("n_tokens").alias("most"))
    return {r.source: r for r in found.collect()}


def test_weights_and_quotas(spark, prose):
    docs = mixture(spark, prose, [2000, 300, 60])
    for budget in (None, 15_000.0, 60_000.0):
        found = sums(mixing.plan(docs, entropy=0.8, repeats=4.0, budget=budget))
        total = {s: r.t for s, r in found.items()}
        assert sum(r.w for r in found.values()) == pytest.approx(1)
        ratio = [math.log(found[a].w / found[b].w) / math.log(total[a] / total[b]) for a, b in (("src0", "src1"), ("src1", "src2"))]
        assert ratio[0] == pytest.approx(ratio[1]) and 0 <= ratio[0] <= 1  # one exponent for all
        size = budget or max(t / found[s].w for s, t in total.items())
        for s, r in found.items():
            quota = min(r.w * size, 4 * r.t)
            assert quota - r.most <= r.taken <= quota + 1e-3 * r.t
    entropy = -sum(r.w * math.log(r.w) for r in sums(mixing.plan(docs, entropy=0.8, repeats=1e9)).values())
    assert entropy == pytest.approx(0.8 * math.log(3), abs=1e-3)
    most = max(r.taken / r.t for r in sums(mixing.plan(docs, entropy=1.0, repeats=2.0)).values())
    assert most <= 2.0 + 1e-6


def test_nothing_is_lost_by_default(spark, prose):
    docs = mixture(spark, prose, [500, 40, 7])
    found = mixing.plan(docs)
    assert found.count() == docs.count() and found.agg(F.min("copies")).first()[0] >= 1
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == found.agg(F.sum("copies")).first()[0]
    assert mixed.select("doc_id").distinct().count() == docs.count()


def test_mixing_odd_rows(spark, odd):
    found = mixing.plan(odd).collect()
    assert len(found) == odd.count() and all(r.copies >= 1 for r in found)
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in found)
    assert mixing.plan(odd.limit(0)).collect() == []


# --- pipeline --------------------------------------------------------------------------------

def test_pipeline_stages(spark, documents):
    docs = documents
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == before.columns, name
        kept.append(docs.count())
    assert kept[1] < kept[0] and kept[2] < kept[1] and kept[3] <= kept[2] and kept[4] >= kept[3]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).orderBy("start").collect()
    assert len(out) == kept[-1]
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]


def test_the_grams_of_a_task_take_bounded_memory():
    """Four million characters: the arrays of one block at a time, under 100 MB."""
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 123, 4000))) for _ in range(1000)]
    batches = [pd.DataFrame({"_text": texts[i : i + 100]}) for i in range(0, 1000, 100)]
    tracemalloc.start()
    try:
        counted = sum(int(rows["n"].sum()) for rows in quality._trusted_grams(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counted == 1000 * 4001
    assert peak < 100e6
