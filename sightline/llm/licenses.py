"""License scan: ordered signature rules behind a keyword filter, native expressions only.

Everything about a text is found within its own row, so nothing is shuffled. The rules' keywords are
looked for first, as parts of the text and not as its words, since a name may be glued to a version or
to letters of another script; only rules whose keyword occurs are tried, so nearly all texts try none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: label: (keyword, name as an expression over a lower-case text, identifier, part of its address).
#: Every text that matches the name has one of its keywords in it.
FAMILIES = {
    "gpl-3.0": ("general public licen|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "gpl-3.0", "gnu.org/licenses/gpl-3"),
    "gpl-2.0": ("general public licen|gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl),? ?(?:version |v\.? ?)?2(?:\.0)?", "gpl-2.0", "gnu.org/licenses/gpl-2"),
    "gpl": ("general public licen", r"gnu general public licen[sc]e", "gpl", "gnu.org/licenses/gpl"),
    "lgpl-3.0": ("general public licen|gpl", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "lgpl-3.0", "gnu.org/licenses/lgpl-3"),
    "lgpl-2.1": ("general public licen|gpl", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl),? ?(?:version |v\.? ?)?2\.1", "lgpl-2.1", "gnu.org/licenses/lgpl-2.1"),
    "lgpl": ("general public licen", r"gnu lesser general public licen[sc]e", "lgpl", "gnu.org/licenses/lgpl"),
    "agpl-3.0": ("general public licen|gpl", r"(?:gnu )?(?:affero general public licen[sc]e|agpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "agpl-3.0", "gnu.org/licenses/agpl-3"),
    "agpl": ("general public licen", r"gnu affero general public licen[sc]e", "agpl", "gnu.org/licenses/agpl"),
    "gfdl": ("free documentation licen", r"gnu free documentation licen[sc]e", "gfdl", "gnu.org/licenses/fdl"),
    "apache-2.0": ("apache licen|apache software licen", r"apache (?:software )?licen[sc]e,? ?(?:version |v\.? ?)?2(?:\.0)?", "apache-2.0", "apache.org/licenses/license-2.0"),
    "apache-1.1": ("apache licen|apache software licen", r"apache (?:software )?licen[sc]e,? ?(?:version |v\.? ?)?1\.1", "apache-1.1", "apache.org/licenses/license-1.1"),
    "apache-1.0": ("apache licen|apache software licen", r"apache (?:software )?licen[sc]e,? ?(?:version |v\.? ?)?1\.0", "apache-1.0", "apache.org/licenses/license-1.0"),
    "apache": ("apache licen|apache software licen", r"apache (?:software )?licen[sc]e", "apache", "apache.org/licenses"),
    "mit": ("mit licen", r"mit licen[sc]e", "mit", "opensource.org/licenses/mit"),
    "mit-0": ("mit no attribution", r"mit no attribution", "mit-0", "opensource.org/licenses/mit-0"),
    "bsd-2-clause": ("bsd", r"(?:2|two)[- ]clause bsd|simplified bsd|freebsd licen[sc]e", "bsd-2-clause", "opensource.org/licenses/bsd-2"),
    "bsd-3-clause": ("bsd", r"(?:3|three)[- ]clause bsd|(?:new|revised|modified) bsd", "bsd-3-clause", "opensource.org/licenses/bsd-3"),
    "bsd-4-clause": ("bsd", r"(?:4|four)[- ]clause bsd|original bsd", "bsd-4-clause", "spdx.org/licenses/bsd-4"),
    "bsd": ("bsd", r"bsd licen[sc]e", "bsd", "opensource.org/licenses/bsd-license"),
    "0bsd": ("bsd", r"zero[- ]clause bsd", "0bsd", "opensource.org/licenses/0bsd"),
    "isc": ("isc licen", r"isc licen[sc]e", "isc", "opensource.org/licenses/isc"),
    "mpl-2.0": ("mozilla public licen", r"mozilla public licen[sc]e,? ?(?:version |v\.? ?)?2(?:\.0)?", "mpl-2.0", "mozilla.org/mpl/2.0"),
    "mpl-1.1": ("mozilla public licen", r"mozilla public licen[sc]e,? ?(?:version |v\.? ?)?1\.1", "mpl-1.1", "mozilla.org/mpl/1.1"),
    "mpl": ("mozilla public licen", r"mozilla public licen[sc]e", "mpl", "mozilla.org/mpl"),
    "epl-2.0": ("eclipse public licen", r"eclipse public licen[sc]e,? ?(?:version |v\.? ?|- v)?2(?:\.0)?", "epl-2.0", "eclipse.org/legal/epl-2.0"),
    "epl-1.0": ("eclipse public licen", r"eclipse public licen[sc]e,? ?(?:version |v\.? ?|- v)?1(?:\.0)?", "epl-1.0", "eclipse.org/legal/epl-v10"),
    "epl": ("eclipse public licen", r"eclipse public licen[sc]e", "epl", "eclipse.org/legal/epl"),
    "cddl-1.0": ("common development and distribution", r"common development and distribution licen[sc]e", "cddl-1.0", "opensource.org/licenses/cddl"),
    "cpl-1.0": ("common public licen", r"common public licen[sc]e", "cpl-1.0", "opensource.org/licenses/cpl1.0"),
    "eupl-1.2": ("european union public licen", r"european union public licen[sc]e", "eupl-1.2", "joinup.ec.europa.eu/page/eupl"),
    "artistic-2.0": ("artistic licen", r"artistic licen[sc]e,? ?(?:version |v\.? ?)?2(?:\.0)?", "artistic-2.0", "opensource.org/licenses/artistic-license-2.0"),
    "artistic": ("artistic licen", r"artistic licen[sc]e", "artistic-1.0", "opensource.org/licenses/artistic-license"),
    "bsl-1.0": ("boost software licen", r"boost software licen[sc]e", "bsl-1.0", "boost.org/license_1_0"),
    "busl-1.1": ("business source licen", r"business source licen[sc]e", "busl-1.1", "mariadb.com/bsl11"),
    "sspl-1.0": ("server side public licen", r"server side public licen[sc]e", "sspl-1.0", "mongodb.com/licensing/server-side-public-license"),
    "elastic-2.0": ("elastic licen", r"elastic licen[sc]e", "elastic-2.0", "elastic.co/licensing/elastic-license"),
    "zlib": ("zlib", r"zlib(?:/libpng)? licen[sc]e", "zlib", "opensource.org/licenses/zlib"),
    "libpng": ("libpng licen", r"libpng licen[sc]e", "libpng", "libpng.org/pub/png/src/libpng-license"),
    "unlicense": ("the unlicense", r"the unlicense", "unlicense", "unlicense.org"),
    "wtfpl": ("you want to public licen", r"do what the fuck you want to public licen[sc]e", "wtfpl", "wtfpl.net"),
    "python": ("python software foundation licen", r"python software foundation licen[sc]e", "psf-2.0", "docs.python.org/3/license"),
    "php-3.01": ("php licen", r"php licen[sc]e", "php-3.01", "php.net/license"),
    "ruby": ("ruby licen", r"ruby licen[sc]e", "ruby", "ruby-lang.org/en/about/license"),
    "postgresql": ("postgresql licen", r"postgresql licen[sc]e", "postgresql", "postgresql.org/about/licence"),
    "openssl": ("openssl licen", r"openssl licen[sc]e", "openssl", "openssl.org/source/license"),
    "curl": ("curl licen", r"curl licen[sc]e", "curl", "curl.se/docs/copyright"),
    "x11": ("x11 licen", r"x11 licen[sc]e", "x11", "spdx.org/licenses/x11"),
    "ncsa": ("illinois/ncsa", r"university of illinois/ncsa open source licen[sc]e", "ncsa", "opensource.org/licenses/ncsa"),
    "ms-pl": ("microsoft public licen", r"microsoft public licen[sc]e", "ms-pl", "opensource.org/licenses/ms-pl"),
    "ms-rl": ("microsoft reciprocal licen", r"microsoft reciprocal licen[sc]e", "ms-rl", "opensource.org/licenses/ms-rl"),
    "osl-3.0": ("open software licen", r"open software licen[sc]e", "osl-3.0", "opensource.org/licenses/osl-3.0"),
    "afl-3.0": ("academic free licen", r"academic free licen[sc]e", "afl-3.0", "opensource.org/licenses/afl-3.0"),
    "ofl-1.1": ("open font licen", r"sil open font licen[sc]e", "ofl-1.1", "scripts.sil.org/ofl"),
    "odbl": ("open database licen", r"open database licen[sc]e", "odbl-1.0", "opendatacommons.org/licenses/odbl"),
    "odc-by": ("open data commons attribution", r"open data commons attribution licen[sc]e", "odc-by-1.0", "opendatacommons.org/licenses/by"),
    "pddl": ("public domain dedication", r"public domain dedication and licen[sc]e", "pddl-1.0", "opendatacommons.org/licenses/pddl"),
    "cc0": ("cc0|creative commons", r"creative commons (?:zero|cc0)|cc0", "cc0-1.0", "creativecommons.org/publicdomain/zero"),
    "cc-by-nc-nd": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by[- ]nc[- ]nd|creative commons attribution-noncommercial-noderiv\w*", "cc-by-nc-nd-4.0", "creativecommons.org/licenses/by-nc-nd"),
    "cc-by-nc-sa": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by[- ]nc[- ]sa|creative commons attribution-noncommercial-sharealike", "cc-by-nc-sa-4.0", "creativecommons.org/licenses/by-nc-sa"),
    "cc-by-nc": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by[- ]nc|creative commons attribution-noncommercial", "cc-by-nc-4.0", "creativecommons.org/licenses/by-nc"),
    "cc-by-nd": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by[- ]nd|creative commons attribution-noderiv\w*", "cc-by-nd-4.0", "creativecommons.org/licenses/by-nd"),
    "cc-by-sa": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by[- ]sa|creative commons attribution-sharealike", "cc-by-sa-4.0", "creativecommons.org/licenses/by-sa"),
    "cc-by": ("cc-by|cc by|creative commons", r"(?:cc|creative commons)[- ]by|creative commons attribution", "cc-by-4.0", "creativecommons.org/licenses/by"),
    "proprietary": ("all rights reserved|proprietary and confidential", r"all rights reserved|proprietary and confidential", "licenseref-proprietary", "spdx.org/licenses/licenseref-proprietary"),
    "public-domain": ("to the public domain", r"(?:released|dedicated|placed) (?:in|in)to the public domain", "licenseref-public-domain", "creativecommons.org/publicdomain/mark"),
}

#: Most telling form first: how sure a detection is, by form.
FORMS = {"identifier": 0.99, "grant": 0.95, "address": 0.9, "name": 0.7}


def rules() -> list[tuple[str, int, str, float, str]]:
    """(keyword, priority, label, confidence, expression); a lower priority comes first.

    Four rules per family: a machine-readable identifier, a sentence that grants, the address and
    the bare name. Families are listed with the specific ones first, which sets the order within a
    form.
    """
    made = []
    for i, (label, (keywords, name, identifier, address)) in enumerate(FAMILIES.items()):
        escaped = [x.replace(".", r"\.") for x in (identifier, address)]
        forms = {
            "identifier": rf"spdx-license-identifier:\s*{escaped[0]}(?:-only|-or-later|\+)?(?![\w.-])",
            "grant": rf"(?:licen[sc]ed|released|distributed|available|provided|governed)\s+(?:under|by)\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?(?:{name})(?![\w])",
            "address": rf"(?:https?://)?(?:www\.)?{escaped[1]}[\w./-]*",
            "name": rf"(?<![\w])(?:{name})(?![\w])",
        }
        for j, (form, expression) in enumerate(forms.items()):
            for keyword in _keywords(form, keywords, address):
                made.append((keyword, j * len(FAMILIES) + i, label, FORMS[form], expression))
    return made


def _keywords(form: str, keywords: str, address: str) -> list[str]:
    if form == "identifier":
        return ["spdx-license-identifier"]
    if form == "address":
        return [address.split("/")[0]]
    return keywords.split("|")


def scan(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """Scan every text: a row for each row.

    Columns: ``row_id``, n_words, n_base (places of the base phrases), first_word and last_word
    (their smallest and largest start in words from 0, else NULL), base_labels and labels
    (distinct, sorted, comma-joined), score (how sure the surest detection is, 0 without any), and
    detections: array of (start, end, priority, label, confidence) in code points of the text.

    Rules are ordered. Of detections with the same extent the first rule's stays; one that lies
    within another is suppressed unless its own rule comes first. NULL texts count as empty: no
    words, no labels (empty strings), score 0. Ids may be NULL or repeated; other columns do not
    matter. Long texts are scanned whole.
    """
    table = rules()
    by_keyword: dict[str, list] = {}
    for keyword, *rest in table:
        by_keyword.setdefault(keyword, []).append(rest)
    literal = F.create_map(*[
        x for k, found in sorted(by_keyword.items()) for x in (
            F.lit(k), F.array(*[
                F.struct(F.lit(p).alias("p"), F.lit(label).alias("label"), F.lit(c).alias("c"), F.lit(e).alias("regex"))
                for p, label, c, e in found
            ]),
        )
    ])
    keywords = F.array(*[F.lit(k) for k in sorted(by_keyword)])
    phrases = {tuple(p.split()): label for p, label in PHRASES.items()}
    telling = sorted({w for p in phrases for w in p} - {"by", "mit"})  # those two are words of other languages

    lower = common.lower_ascii(common.whole(text))
    rows = common.barrier(docs.select(row_id, lower.alias("_text")), _words=F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    rows = common.barrier(
        rows, _n=F.size("_words"), _hits=F.filter(keywords, lambda k: F.contains(F.col("_text"), k)),
        _some=F.arrays_overlap(F.col("_words"), F.array(*[F.lit(w) for w in telling])),
    )

    def stands(i, phrase):
        same = [F.get(F.col("_words"), i + k) == w for k, w in enumerate(phrase)]
        out = same[0]
        for x in same[1:]:
            out = out & x
        return out

    def any_phrase(i):
        out = F.lit(False)
        for phrase in phrases:
            out = out | F.coalesce(stands(i, phrase), F.lit(False))
        return out

    positions = F.sequence(F.lit(0), F.col("_n") - 1)
    none = F.array().cast("array<int>")
    rows = common.barrier(
        rows,
        _starts=F.when(F.col("_some") & (F.col("_n") > 0), F.filter(positions, any_phrase)).otherwise(none),
        _rules=F.when(
            F.size("_hits") > 0,
            F.array_distinct(F.flatten(F.transform(F.col("_hits"), lambda k: F.element_at(literal, k)))),
        ),
    )
    def somewhere(phrase):
        return F.exists(F.col("_starts"), lambda i: stands(i, phrase))

    base = [F.when(somewhere(phrase), F.lit(label)) for phrase, label in phrases.items()]
    rows = common.barrier(
        rows,
        _base=F.when(F.size("_starts") > 0, F.array_sort(F.array_compact(F.array(*base))))
        .otherwise(F.array().cast("array<string>")),
        _found=F.when(F.size("_rules") > 0, F.array_sort(F.flatten(F.transform(F.col("_rules"), lambda r: F.transform(
            common.find_all(F.col("_text"), r["regex"]),
            lambda s: F.struct(
                s["s"].alias("start"), (-s["e"]).alias("before"), r["p"].alias("priority"),
                r["label"].alias("label"), r["c"].alias("confidence"),
            ),
        ))))),
    )
    kept = common.barrier(rows, _kept=F.when(F.size("_found") > 0, _unsuppressed(F.col("_found"))))
    detections = F.coalesce(F.col("_kept"), F.array().cast(
        "array<struct<start:int,end:int,priority:int,label:string,confidence:double>>"
    ))
    kept = common.barrier(kept, detections=detections)
    labels = F.array_sort(F.array_union(F.col("_base"), F.col("detections.label")))
    surest = F.greatest(
        F.coalesce(F.array_max(F.col("detections.confidence")), F.lit(0.0)),
        F.when(F.size("_base") > 0, F.lit(FORMS["name"])).otherwise(F.lit(0.0)),
    )
    return kept.select(
        row_id, F.col("_n").cast("bigint").alias("n_words"), F.size("_starts").cast("bigint").alias("n_base"),
        F.array_min("_starts").cast("bigint").alias("first_word"),
        F.array_max("_starts").cast("bigint").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        surest.alias("score"), "detections",
    )


def _unsuppressed(found: Column) -> Column:
    """Detections that no other one suppresses.

    They come by start, then longest, then rule, so whatever contains a detection precedes it. The
    fold carries, for each form, the furthest end seen and the best rule with that end.
    """
    forms, families = len(FORMS), len(FAMILIES)
    kind = "array<struct<start:int,end:int,priority:int,label:string,confidence:double>>"
    start = F.struct(*[F.lit(-1).alias(f"e{j}") for j in range(forms)], F.array().cast(kind).alias("kept"))

    def step(acc, d):
        end, form = -d["before"], F.floor(d["priority"] / families)
        covered = F.lit(False)
        for j in range(forms):
            # within a detection of the same or a better form that came before it
            covered = covered | ((acc[f"e{j}"] >= end) & (form >= j))
        row = F.struct(d["start"].alias("start"), end.alias("end"), d["priority"].alias("priority"), d["label"].alias("label"), d["confidence"].alias("confidence"))
        ends = [
            F.when((form == j) & ~covered, F.greatest(acc[f"e{j}"], end)).otherwise(acc[f"e{j}"]).alias(f"e{j}")
            for j in range(forms)
        ]
        return F.struct(*ends, F.when(covered, acc["kept"]).otherwise(F.array_append(acc["kept"], row)).alias("kept"))

    return F.aggregate(found, start, step, lambda acc: acc["kept"])


@query("op10_license_scan")
def op10_license_scan(spark, sf):
    return scan(common.table(spark, sf, "documents")).drop("detections")
