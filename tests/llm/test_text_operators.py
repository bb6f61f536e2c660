"""PII, licenses, token counts and token files against plain Python."""

import hashlib
import json
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm import licenses, pii, tokenfiles, tokens
from sightline.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path(tokens.VOCABULARY)


# --- personal data ---------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)
    return total % 10 == 0


def passes(kind, value):
    n = re.sub("[^0-9]", "", value)
    return {
        "email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
        "card": 12 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15,
    }[kind]


def base_spans(text):
    return sorted(
        (m.start(), m.end(), k) for k, (kind, p) in enumerate(BASE.items())
        for m in re.finditer(p, text or "") if passes(kind, m.group())
    )


TRICKY = [
    "a@b.com_x@y.org,-@-.-.-", "x@y z@", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.2.3 001.002.003.004", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "+1 (988) 555-2485.", "+49 30 1234567 +1-2", "😀 a.b@c.de 10.0.0.1", "9" * 5000, "a" * 20000,
    "a@b" + ".c" * 30000, "call (988) 555-2485 now", "+()()()", "1 2 3 4 5 6 7 8 9 0 1 2 3", "@@@..@.@", None, "",
]


def test_base_spans_equal_plain_matching(spark, odd, documents):
    rows = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")
    for docs in (rows, documents, odd):
        found = pii.find(docs).collect()
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        got = sorted((str(r.doc_id), sorted((s.s, s.e, s.k) for s in r.spans if s.base)) for r in found)
        assert got == sorted((str(i), base_spans(t)) for i, t in texts)


def test_votes_add_what_context_supports(spark):
    rows = [(i, f"please call me, phone: (988) 555-{i:04d} thanks") for i in range(60)]
    rows += [(100 + i, f"invoice order {i:03d}") for i in range(60)]
    rows += [(300 + i, f"phone +1 988 555 {i:04d}, mail: a{i}@mail.com") for i in range(60)]
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(pii.KINDS[found[i][0].k] == "tel" and not found[i][0].base for i in range(60))
    assert not any(found[100 + i] for i in range(60))


def test_pii_query_digests(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op1_pii_spans"](spark, SF).collect():
        spans = base_spans(texts[r.doc_id])
        listed = ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2])))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[2] == k for x in spans) for k in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_pii_of_nothing(spark):
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


# --- licenses --------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_licenses(text):
    found = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        words = phrase.split()
        for i in range(len(found) - len(words) + 1):
            if found[i : i + len(words)] == words:
                starts.append(i)
                labels.add(label)
    return len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


LICENSED = [
    "MIT License mit license. Mit der Lizenz", "Licensed under the Apache License, Version 2.0", "cc by cc by-nc 4.0",
    "SPDX-License-Identifier: GPL-3.0-or-later", "GNU General Public License, version 3", "see https://opensource.org/licenses/MIT",
    "gnu general", "public license gnu", None, "", "the three-clause BSD and no more", "É MIT LICENSE É",
]


def test_base_places_equal_plain_search(spark, odd, documents):
    rows = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id bigint, text string")
    for docs in (rows, documents, odd):
        got = sorted(
            (str(r.doc_id), str((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in licenses.scan(docs).collect()
        )
        assert got == sorted((str(r.doc_id), str(base_licenses(r.text))) for r in docs.collect())


def test_ordered_rules_and_suppression(spark):
    rows = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan(rows).collect()}
    assert found[1].labels == "apache,apache-2.0"  # the base label stays, the grant suppresses the bare name
    assert [d.label for d in found[1].detections] == ["apache-2.0"]
    assert found[3].labels == "gpl-3.0" and found[3].score == 0.99
    assert found[5].labels == "mit" and found[5].score == 0.9
    assert "gpl-3.0" in found[4].labels.split(",")
    assert found[10].labels == "bsd-3-clause"
    assert found[6].labels == "" and found[6].score == 0
    d = found[1].detections[0]
    assert LICENSED[1][d.start : d.end] == LICENSED[1]


def test_there_are_hundreds_of_rules():
    assert len({r[4] for r in licenses.rules()}) > 200


def matching(parsed, rest=("",)):
    """Texts that an expression matches: each alternative, optional parts left out and put in."""
    found = [""]
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            more = [chr(arg)]
        elif op == "IN":
            more = [chr(x) for kind, x in arg if str(kind) == "LITERAL"] or [" " if str(arg[0][1]) == "CATEGORY_SPACE" else "a"]
        elif op == "MAX_REPEAT":
            more = ([""] if arg[0] == 0 else []) + matching(arg[2])
        elif op == "BRANCH":
            more = [x for part in arg[1] for x in matching(part)]
        elif op == "SUBPATTERN":
            more = matching(arg[3])
        else:
            more = [""]
        found = [f + m for f in found for m in more]
    return found


def test_no_rule_is_dropped_by_the_keywords():
    by_rule = {}
    for keyword, priority, *_, expression in licenses.rules():
        by_rule.setdefault((priority, expression), set()).add(keyword)
    for (priority, expression), keywords in by_rule.items():
        name = list(licenses.FAMILIES.values())[priority % len(licenses.FAMILIES)][1]
        bare = expression.replace(f"(?:{name})", "name") if priority // len(licenses.FAMILIES) in (1, 3) else expression
        texts = matching(re._parser.parse(name if bare != expression else expression))
        assert texts
        for text in texts:
            assert any(k in text for k in keywords), (expression, text)


def test_names_may_be_glued(spark):
    texts = {
        "released under the GPLv3": "gpl-3.0", "Released under the GPL3.": "gpl-3.0", "released under the gplv2": "gpl-2.0",
        "it is LGPLv3": "lgpl-3.0", "it is LGPLv2.1": "lgpl-2.1", "it is AGPLv3": "agpl-3.0", "a FreeBSD license": "bsd-2-clause",
        "採用Apache License": "apache", "see mygnu.org/licenses/gpl-3.0": "gpl-3.0",
    }
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.labels.split(",") for r in licenses.scan(rows).collect()}
    assert all(label in found[i] for i, label in enumerate(texts.values())), found


# --- tokens ----------------------------------------------------------------------------------

TEXTS = [
    "it's John's. don't", "a\n\nb", "\nx", "tab\tb c", "<|endoftext|>", "a <|endoftext|> b\n<|endoftext|>c", "  two  spaces ",
    "naïve café, Ünï! 12.5 $$$ a... b.. c., ;d", "a\xa0b c\n\nd", "word.\x0b x", "\x1f", "a\x1fb", "I'll O'Reilly's 's", None, "",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_counts_equal_the_library_and_are_cached(spark, folder, library, odd, documents):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for docs in (rows, odd, documents):
        got = tokens.token_counts(docs, folder, VOCABULARY).collect()
        want = []
        for r in docs.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((str(r.doc_id), len((r.text or "").encode()), n, n > 512))
        assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted(want)
    cached = spark.read.parquet(folder)
    distinct = rows.select("text").union(odd.select("text")).union(documents.select("text")).select(F.coalesce("text", F.lit(""))).distinct()
    assert cached.count() == distinct.count()  # every text once, NULL as the empty one
    tokens.token_counts(rows, folder, VOCABULARY).collect()
    assert spark.read.parquet(folder).count() == cached.count()


def test_another_tokenizer_version_is_counted_anew(spark, folder, tmp_path):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    other = tmp_path / "other.json"
    other.write_text(open(VOCABULARY, encoding="utf-8").read().replace('"dropout": null', '"dropout":  null') + "\n")
    for path in (VOCABULARY, str(other)):
        assert tokens.token_counts(docs, folder, path).first().n_tokens == 3
    assert spark.read.parquet(folder).count() == 2


def test_counts_of_nothing(spark, folder):
    assert tokens.token_counts(spark.createDataFrame([], "doc_id bigint, text string"), folder, VOCABULARY).collect() == []


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), np.array([7]), np.full(1001, 3), rng.integers(0, 9, 5000), rng.integers(0, 50_257, 3000), np.tile([1, 2, 3], 900)):
        ids = ids.astype(np.uint32)
        packed = tokenfiles.Grammar.of(ids, least=2).packed()
        grammar = tokenfiles.Grammar.unpacked(*packed)
        assert grammar.decode().tolist() == ids.tolist()
        for start, n in ((0, 5), (17, 100), (990, 500), (10_000, 3)):
            assert grammar.decode(start, n).tolist() == ids[start : start + n].tolist()
    assert len(tokenfiles.Grammar.of(np.tile([1, 2, 3], 900).astype(np.uint32)).symbols) < 300


def test_a_worker_gives_back_what_it_remembers(monkeypatch):
    """Nothing is left of the pieces that a task has met when its token file is written."""
    encode = tokens.Encoder(tokens.definition_at(VOCABULARY))
    texts = [" ".join(["the", *(f"word{i}x{j}" for j in range(300))]) for i in range(30)]
    whole = encode._whole(texts)
    assert list(encode.each(texts, size=1000)) == whole and encode.after_space
    monkeypatch.setattr(tokenfiles, "encoder", lambda definition: encode)
    monkeypatch.setattr(tokenfiles.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    rows = list(tokenfiles._encoded("", 2000)(iter([pd.DataFrame({"_id": list(map(str, range(30))), "_text": texts})])))
    assert sum(int(r.n_tokens.iloc[0]) for r in rows) == sum(len(w) // 4 + 1 for w in whole)
    assert not encode.first and not encode.after_space


def test_no_frequent_pair_is_left():
    """Repeated passages, runs of one id and prose: what remains has no pair LEAST times, not counting overlaps."""
    rng = np.random.default_rng(5)
    passages = [rng.integers(0, 5000, 200) for _ in range(40)]
    repeated = np.concatenate([passages[i] for i in rng.integers(0, 40, 1500)])
    for ids in (repeated, np.zeros(70_001, int), np.tile([7, 7, 7, 8], 4000), rng.zipf(1.3, 200_000) % 3000, np.arange(50_000) % 3):
        ids = ids.astype(np.uint32)
        grammar = tokenfiles.Grammar.of(ids)
        assert (grammar.decode() == ids).all()
        counts, last = Counter(), None
        for pair in zip(grammar.symbols.tolist(), grammar.symbols[1:].tolist()):
            last = None if pair[0] == pair[1] and pair == last else pair  # of a run every other place
            if last:
                counts[pair] += 1
        assert max(counts.values(), default=0) < tokenfiles.LEAST
        at = len(ids) // 3
        assert (grammar.decode(at, 777) == ids[at : at + 777]).all()
    assert len(tokenfiles.Grammar.of(repeated.astype(np.uint32)).symbols) < 6000  # 300,000 ids


def test_a_round_of_pairs_looks_where_the_definition_says():
    """Places beside a new symbol or of a pair that was left; pairs as numbers on both sides of 16 bits."""
    rng = np.random.default_rng(9)
    symbols, left, right = rng.integers(0, 40, 5000).astype(np.int32), np.array([3, 7, 7], np.int32), np.array([7, 7, 9], np.int32)
    want = [
        i for i, (x, y) in enumerate(zip(symbols.tolist(), symbols[1:].tolist()))
        if x >= 36 or y >= 36 or (x in left.tolist() and y in right.tolist())
    ]
    assert tokenfiles._looked_at(symbols, 36, 40, left, right).tolist() == want
    for top in (1 << 16, (1 << 16) + 1):
        x, y = rng.integers(0, top, (2, 500)).astype(np.int32)
        x[0] = y[1] = top - 1
        back = tokenfiles._unpacked(tokenfiles._packed(x, y, top))
        assert (back[0] == x).all() and (back[1] == y).all()
    ids = np.concatenate([rng.integers(0, 60, 40_000), [(1 << 16) - 30]]).astype(np.uint32)  # rules go beyond 16 bits
    grammar = tokenfiles.Grammar.of(ids)
    assert grammar.base < 1 << 16 < grammar.base + len(grammar.rules) and (grammar.decode() == ids).all()


def expected_files(docs, library):
    rows, at = [], 0
    keyed = [(r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs]
    for known, i, text in sorted(keyed, key=lambda x: x[:2]):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        rows.append((i if known else None, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return rows


def test_files_hold_the_ids_in_order(spark, folder, library, documents):
    tokenfiles.write(documents.repartition(7), folder, VOCABULARY, block=5000)
    got = tokenfiles.read(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_files(documents.collect(), library)
    assert spark.read.parquet(folder).count() > 20  # blocks


def test_files_of_odd_rows(spark, folder, library, odd):
    tokenfiles.write(odd, folder, VOCABULARY)
    got = [tuple(r) for r in tokenfiles.read(spark, folder).orderBy("start").collect()]
    want = expected_files(odd.collect(), library)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), r[2], r[3]) for r in want)
    ends = [r[1] + r[2] for r in got]
    assert [r[1] for r in got] == [0, *ends[:-1]]


def test_files_of_nothing(spark, folder):
    tokenfiles.write(spark.createDataFrame([], "doc_id bigint, text string"), folder, VOCABULARY)
    assert tokenfiles.read(spark, folder).collect() == []


def test_encoding_by_pieces_equals_the_library():
    encode, rng = tokens.Encoder(tokens.definition_at(VOCABULARY)), np.random.default_rng(8)
    letters = list("abcdefghij ABC  \n\n\t.,;:!?'\"0123456789-éüßñ中文😀 ​\x1f́_ ")
    words = ["don't", "it's", "<|endoftext|>", "a.b", "U.S.", "x1", "3.14", "Über", "naïve,", "é", "co-op", "I'll", "'s", "­soft", "ﬁ", "word.", "word"]
    texts = ["", " ", "\n", "a", "a\nb", "a \nb", " a", "a ", "a  b"]
    texts += ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(4000)]
    texts += [str(rng.choice([" ", "\n"])).join(rng.choice(words, rng.integers(1, 12))) for _ in range(4000)]
    assert list(encode.each(texts, size=5000)) == encode._whole(texts)


def test_marks_behind_letters_are_encoded_once():
    """Words of letters take the short way whatever marks of ASCII follow them, and that is what the library gives."""
    encode, rng = tokens.Encoder(tokens.definition_at(VOCABULARY)), np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeéüß"), rng.integers(1, 9))) for _ in range(600)]
    texts = [" ".join(w + m for w in words) for m in ("$$$", "!!", "...", ".)", "'", "__", "-")]
    texts += [" ".join(w + str(rng.choice(["'s", "._a", "<|endoftext|>", ".1", "’", "'t!", ""])) + "." for w in words)]
    whole, calls = encode._whole(texts), []
    one_by_one = encode._whole
    encode._whole = lambda found: calls.extend(found) or one_by_one(found)
    assert list(encode.each(texts)) == whole
    assert len(calls) < 1000  # of 4,800 words; the 600 of the last text have no short way


def test_added_tokens_that_begin_in_a_word():
    parts = json.loads(tokens.definition_at(VOCABULARY))
    texts = ["cab! ab! word## ##", "ab!\nword##!", "a ## b## ab!!"]
    for content, alone in (("ab!", False), ("##", True), ("##", False)):
        token = {**parts["added_tokens"][0], "id": 50_300, "content": content, "single_word": alone, "special": False}
        encode = tokens.Encoder(json.dumps({**parts, "added_tokens": [*parts["added_tokens"], token]}))
        assert list(encode.each(texts)) == encode._whole(texts)
