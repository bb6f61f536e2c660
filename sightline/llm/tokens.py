"""Texts to ids by a public vocabulary, and token counts behind a digest cache.

A text's count depends on its content and the tokenizer alone, so both are digested (the content
after normalisation: NULL becomes the empty text; byte-level vocabularies allow no more) and joined
to the counts of earlier runs. Only distinct texts without a count are encoded, and their counts are
appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable, Iterable, Iterator
from string import punctuation

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline import session
from sightline.llm import common
from sightline.llm.registry import query
from sightline.sources import folders

VOCABULARY = "byte_bpe_50k.json"
#: Context length above which a document is marked, in tokens.
LIMIT = 512
#: Pieces a worker remembers (it starts anew beyond them), and the longest piece worth it.
REMEMBERED, LONGEST = 400_000, 64

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens bigint"


class Encoder:
    """Texts to ids, piece by piece.

    A byte-level vocabulary splits texts by a fixed expression before it merges bytes, and there is
    always a split at a single space or line break between two other characters. So texts are cut
    there, and a piece goes to the library when it is first seen. A piece of letters, with a space before
    or marks of ASCII behind, is one or two units of that split, so its letters go to the library's merging
    directly and its marks are looked up apart.
    Texts with other white space are encoded whole, and so is everything by vocabularies that
    normalise or split otherwise.
    """

    def __init__(self, definition: str):
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        parts = json.loads(definition)
        split = parts.get("pre_tokenizer") or {}
        added = [t["content"] for t in parts["added_tokens"]]
        self.by_piece = (
            parts.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not any(x.split() != [x] for x in added) and not any(t["lstrip"] or t["rstrip"] for t in parts["added_tokens"])
        )
        self.by_word = (
            self.by_piece and parts["model"]["type"] == "BPE" and not any(x[0].isalpha() or len(x) == 1 for x in added)
            and not any(t["single_word"] for t in parts["added_tokens"])
        )
        # a line's first word, the words that a space stands before, and marks behind letters
        self.first, self.after_space, self.marks = Pieces(self._piece), Pieces(self._piece), Pieces(self._mark)
        # the library's stand-ins for bytes: printable ones for themselves, the others from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in plain]
        # a byte without an entry would cost an exception
        self.stand_ins = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}
        self.space = chr(self.stand_ins[32])
        self.merged = self.library.model.tokenize
        self.line_break = self._whole(["\n"])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _piece(self, word: str, known: Pieces) -> bytes:
        """Ids of a piece: ``word`` as ``known`` has it, after a space or first in its line."""
        lead = " " if known is self.after_space else ""
        if self.by_word:
            body = word.rstrip(punctuation)
            # letters of ASCII stand for themselves
            if body.isalpha() and (body.isascii() or max(body) < "\u0250"):
                if len(body) < len(word):
                    return known[body] + self.marks[word[len(body) :]]
                units = body if body.isascii() else body.encode().decode("latin-1").translate(self.stand_ins)
                return array("I", [t.id for t in self.merged(self.space + units if lead else units)]).tobytes()
        return self._whole([lead + word])[0]

    def _mark(self, marks: str, known: Pieces) -> bytes:
        return self._whole([marks])[0]

    def _by_words(self, text: str) -> bytes | None:
        """The ids of a text whose only white space are single spaces and line breaks; None for others."""
        if (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
            or not text.replace("\n", "").isprintable()
        ):
            return None
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self.first[first] + b"".join(map(self.after_space.__getitem__, rest)))
        for known in (self.first, self.after_space, self.marks):
            if len(known) > REMEMBERED:
                known.clear()
        return self.line_break.join(lines)

    def forget(self) -> None:
        """Give back what the pieces take; a worker lives on after its task."""
        self.first.clear()
        self.after_space.clear()
        self.marks.clear()

    def each(self, texts: Iterable[str], size: int = 2_000_000) -> Iterator[bytes]:
        """The ids of every text as native unsigned 32-bit numbers; about ``size`` characters are held."""
        held, done, whole = 0, [], []
        for text in texts:
            ids = b"" if not text else self._by_words(text) if self.by_piece else None
            if ids is None:
                whole.append((len(done), text))
            done.append(ids)
            held += len(text)
            if held >= size:
                yield from self._complete(done, whole)
                held, done, whole = 0, [], []
        yield from self._complete(done, whole)

    def _complete(self, done: list[bytes | None], whole: list[tuple[int, str]]) -> list[bytes]:
        for (at, _), ids in zip(whole, self._whole([t for _, t in whole])):
            done[at] = ids
        return done


class Pieces(dict):
    """Pieces to ids; one that is not known is encoded, and remembered unless it is long."""

    def __init__(self, encode: Callable[[str, Pieces], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece, self)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """The worker's encoder, made once per process."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def definition_at(path: str) -> str:
    """A vocabulary's definition (1.5 MB here); it is sent to the workers, who need no such file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _counting(definition: str, version: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(definition)
        for batch in batches:
            totals = [len(ids) // 4 for ids in encode.each(batch["text"])]
            yield pd.DataFrame({"digest": batch["digest"], "tokenizer": version, "n_tokens": totals})
    return run


def token_counts(
    docs: DataFrame, cache: str, tokenizer: str, text: str = "text", row_id: str = "doc_id", limit: int = LIMIT
) -> DataFrame:
    """Count every text's tokens: (``row_id``, n_bytes, n_tokens, over_limit), a row for each row.

    ``cache`` is a folder of Parquet files, made if missing; ``tokenizer`` the path of a vocabulary
    for the tokenizers library. Ids may be NULL or repeated and other columns do not matter. A NULL
    text counts as the empty one: 0 bytes, 0 tokens. An empty table gives an empty result. Texts
    are encoded whole, whatever their length; copies are encoded once and hot digests are joined
    as narrow rows that adaptive execution splits. Runs that overlap may both append a count of
    the same text; such counts are equal and are read as one.
    """
    spark = docs.sparkSession
    definition = definition_at(tokenizer)
    version = hashlib.sha256(definition.encode()).hexdigest()
    content = docs.select(
        F.col(row_id), common.whole(text).alias("text"),
        F.unhex(F.sha2(common.whole(text), 256)).alias("digest"),
    )
    if not folders.exists(spark, cache):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    misses = content.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    with common.arrow_rows(spark, 512):
        misses.select("digest", "text").mapInPandas(_counting(definition, version), CACHE_SCHEMA).write.mode(
            "append"
        ).parquet(cache)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    counts = common.stored(known.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    narrow = content.select(row_id, F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    return narrow.join(counts, "digest", "left").select(
        row_id, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


@query("op9_token_counts")
def op9_token_counts(spark, sf):
    cache = session.scratch_path(spark, "token-cache")
    return token_counts(common.table(spark, sf, "documents"), cache, public_tokenizers.path(VOCABULARY))
