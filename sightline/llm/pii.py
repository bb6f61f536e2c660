"""Personal data by weak supervision, native expressions only.

Candidates are what the base patterns match (also the matches that fail their checks) and what a few
looser patterns match. Five labelers vote on each: shape, gazetteer, context, checksum, isolation.
Expectation-maximisation over the vote patterns of all candidates estimates how reliable each
labeler is and how likely each candidate is personal; a logistic span classifier is then trained on
those soft labels and decides on the candidates that are not base spans.

Candidates are found once, row by row, and stored without the texts. What reaches the driver is the
number of candidates per vote pattern: at most kinds x 3^5 x length classes rows, whatever the input.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

#: Kinds in the order of the output; the first four have base rules.
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "ssn", "iban", "tel"]
LABELERS = ["shape", "gazetteer", "context", "checksum", "isolation"]
LENGTHS = [8, 12, 16, 20, 28, 40]

#: Same matches as the base expressions. Possessive repeats and the look-behinds only cut retries
#: that cannot succeed, so runs of any length take linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "tel": r"(?<![0-9+(])\([0-9]{2,5}\)[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])",
}
#: A text without this has no match.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+", "ssn": "-", "iban": "", "tel": "("}

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Gazetteers (fixed values): top-level domains, card issuers, calling codes, account countries.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|ai|app|dev|co|me|tv|de|fr|es|it|uk|us|ca|ch|at|nl|be|pl|pt|se|no|dk|fi|cz|ru|ua|cn|jp|kr|in|br|mx|ar|cl|au|nz|za|eu"
RESERVED_DOMAINS = "test|invalid|localhost|local|internal"
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|35|6(?:011|4[4-9]|5)|62|50|5[6-9])"
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|35[0-9]|37[0-9]|38[0-9]|42[0-9]|5[09][0-9]|67[0-9]|68[0-9]|69[0-9]|85[0-9]|88[0-9]|96[0-9]|97[0-9]|99[0-9]"
ACCOUNTS = "AT|BE|CH|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK|TR"
PRIVATE_NETS = r"^(?:0|10|127|255|22[4-9]|23[0-9])\.|^192\.168\.|^169\.254\.|^172\.(?:1[6-9]|2[0-9]|3[01])\."

#: Context words by kind, and those that tell of something else.
CONTEXT = {
    "email": "e-?mail|mail|contact|write|correo|courriel|kontakt|from|to",
    "ip": "ip|address|server|host|client|login|adresse|direcci[oó]n",
    "card": "card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|handy|whatsapp",
    "ssn": "ssn|social security|taxpayer",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "tel": "phone|tel|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono|handy|whatsapp",
}
OTHERWISE = "version|order|invoice|isbn|issn|serial|part no|model|build|release|figure|section|page"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total, i):
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _passes(kind: str, v: Column) -> Column:
    """The base checks; for the looser kinds what their numbers must satisfy."""
    if kind == "ip":
        return v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.char_length(_digits(v))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(v))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "ssn":
        return ~v.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "iban":
        return F.char_length(F.regexp_replace(v, " ", "")).between(15, 34)
    if kind == "tel":
        return n.between(9, 13)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1 or, for neither, 0; without ``no`` whatever is not a yes is a no."""
    no = ~yes if no is None else no
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("byte")


def _votes(kind: str, v: Column, around: tuple[Column, Column]) -> list[Column]:
    before, after = around
    n = F.char_length(_digits(v))
    gazetteer = {
        "email": _vote(v.rlike(rf"(?i)\.(?:{DOMAINS})$"), v.rlike(rf"(?i)\.(?:{RESERVED_DOMAINS})$")),
        "ip": _vote(~v.rlike(PRIVATE_NETS)),
        "card": _vote(_digits(v).rlike(ISSUERS)),
        "phone": _vote(v.rlike(rf"^\+(?:{CALLING})")),
        "iban": _vote(v.rlike(f"^(?:{ACCOUNTS})")),
        "tel": _vote(v.rlike(r"^\([02-9]")),
    }.get(kind, F.lit(0).cast("byte"))
    checksum = {
        "email": _vote(~v.rlike(r"\.\.|^\.|-\.") & (F.char_length(v) <= 254)),
        "ip": _vote(~v.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(F.when(n.between(2, 40), _luhn(_digits(v))).otherwise(False)),
        "phone": _vote(n.between(9, 15)),
    }.get(kind, F.lit(0).cast("byte"))
    return [
        _vote(_passes(kind, v)), gazetteer,
        _vote(before.rlike(rf"(?i)(?<!\w)(?:{CONTEXT[kind]})\W{{0,5}}(?:\w+\W{{1,3}}){{0,2}}$"), before.rlike(rf"(?i)(?<!\w)(?:{OTHERWISE})(?!\w)")),
        checksum, _vote(~before.rlike(r"[\w.-]$") & ~after.rlike(r"^[\w-]")),
    ]


def candidates(text: Column, kind: str) -> Column:
    """Array of (kind, s, e, base, five votes, length class) of a text's matches of one kind."""
    i = KINDS.index(kind)

    def judged(m):
        votes = _votes(kind, m["v"], (m["before"], m["after"]))
        size = reduce(lambda a, b: a + b, [(m["e"] - m["s"] > n).cast("int") for n in LENGTHS])
        return F.struct(
            F.lit(i).alias("k"), m["s"].alias("s"), m["e"].alias("e"),
            (_passes(kind, m["v"]) if kind in BASE else F.lit(False)).alias("base"),
            *[v.alias(name) for name, v in zip(LABELERS, votes)], size.alias("size"),
        )

    return F.transform(common.find_all(text, F.lit(PATTERNS[kind])), judged)


def _reliabilities(patterns: list, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Dawid-Skene over vote patterns: (how likely each pattern is personal, labeler reliabilities).

    Starts from the majority vote. Priors are per kind, reliabilities per labeler over all kinds;
    one pseudo-count each keeps them off 0 and 1.
    """
    votes = np.array([[p[name] for name in LABELERS] for p in patterns], dtype=int)
    kinds, counts = np.array([p["k"] for p in patterns]), np.array([p["n"] for p in patterns], dtype=float)
    likely = np.clip(0.5 + votes.sum(axis=1) / (2 * len(LABELERS)), 0.05, 0.95)
    tables = {}
    for _ in range(rounds):
        log_odds = np.zeros(len(patterns))
        for k in set(kinds):
            own = kinds == k
            prior = (counts[own] @ likely[own] + 1) / (counts[own].sum() + 2)
            log_odds[own] = np.log(prior / (1 - prior))
        for j, name in enumerate(LABELERS):
            tables[name] = {}
            total = [counts @ likely + 3, counts @ (1 - likely) + 3]
            for vote in (-1, 0, 1):
                own = votes[:, j] == vote
                given = [1 + counts[own] @ likely[own], 1 + counts[own] @ (1 - likely[own])]
                tables[name][vote] = given[0] / total[0], given[1] / total[1]
                log_odds[own] += np.log(tables[name][vote][0] / tables[name][vote][1])
        likely = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return likely, tables


def _features(p) -> list[float]:
    row = [1.0] + [float(p["k"] == k) for k in range(1, len(KINDS))]
    row += [float(p[name] == vote) for name in LABELERS for vote in (-1, 1)]
    return row + [float(p["size"] == s) for s in range(1, len(LENGTHS) + 1)]


def _classifier(patterns: list, likely: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression on the soft labels, by Newton's method."""
    x, n = np.array([_features(p) for p in patterns]), np.array([p["n"] for p in patterns], dtype=float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (likely - p)) - ridge * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def _probability(c: Column, w: np.ndarray) -> Column:
    """The classifier as an expression over one candidate."""
    at = iter(float(x) for x in w)
    z = F.lit(next(at))
    for k in range(1, len(KINDS)):
        z = z + F.when(c["k"] == k, next(at)).otherwise(0.0)
    for name in LABELERS:
        for vote in (-1, 1):
            z = z + F.when(c[name] == vote, next(at)).otherwise(0.0)
    for s in range(1, len(LENGTHS) + 1):
        z = z + F.when(c["size"] == s, next(at)).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, text: str = "text", row_id: str = "doc_id", sure: float = 0.9) -> DataFrame:
    """Personal data in every text: (``row_id``, spans), a row for each row.

    ``spans`` is an array of (s, e, k, base, p) by start, then kind: place in code points (end
    exclusive), index into ``KINDS``, whether a base rule found it, the classifier's probability.
    Base spans always stay; other candidates stay from probability ``sure`` on, if they overlap no
    base span and at least two labelers vote for them.

    A NULL text counts as empty and has no spans. Ids may be NULL or repeated, other columns do not
    matter, an empty table gives an empty result (nothing is trained). Long texts are read whole.
    """
    whole = docs.select(row_id, common.whole(text).alias("_text"))
    t = F.col("_text")
    digits = t.rlike("[0-9]")
    none = F.filter(candidates(F.lit(""), "email"), lambda c: F.lit(False))
    found = F.concat(*[
        F.when((t.contains(NEEDED[k]) & digits) if k != "email" else t.contains("@"), candidates(t, k)).otherwise(none)
        for k in KINDS
    ])
    rows = common.stored(common.barrier(whole, _found=found).select(row_id, "_found"), "pii-candidates")
    each = rows.select(F.inline("_found"))
    patterns = each.groupBy("k", *LABELERS, "size").agg(F.count("*").alias("n")).collect()
    if patterns:
        weights = _classifier(patterns, _reliabilities(patterns)[0])
    else:
        weights = np.zeros(len(_features({"k": 0, "size": 0} | dict.fromkeys(LABELERS, 0))))

    def scored(c):
        return F.struct(c["s"].alias("s"), c["e"].alias("e"), c["k"].alias("k"), c["base"].alias("base"), _probability(c, weights).alias("p"))

    def stays(c):
        for_it = reduce(lambda a, b: a + b, [(c[name] == 1).cast("int") for name in LABELERS])
        over = F.exists(F.col("_base"), lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
        return c["base"] | ((for_it >= 2) & (_probability(c, weights) >= sure) & ~over)

    rows = common.barrier(rows, _base=F.filter("_found", lambda c: c["base"]))
    return rows.select(row_id, F.array_sort(F.transform(F.filter("_found", stays), scored)).alias("spans"))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    by_place = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"], x["k"], x["e"])))
    return F.array_join(F.transform(by_place, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def _of_kind(k: int):
    return lambda x: x["k"] == k


@query("op1_pii_spans")
def op1_pii_spans(spark, sf):
    rows = common.barrier(
        find(common.table(spark, sf, "documents")), _base=F.filter("spans", lambda x: x["base"])
    )
    counts = [
        F.size(F.filter("_base", _of_kind(k))).cast("bigint").alias(f"n_{name}")
        for k, name in enumerate(BASE)
    ]
    return rows.select(
        "doc_id", *counts, F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
