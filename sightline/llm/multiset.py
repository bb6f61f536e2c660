"""Document fingerprints: a homomorphic multiset hash of the paragraphs.

A paragraph (what stands between line feeds) is hashed to a wide vector of 32-bit lanes, and a
document's fingerprint is the sum of its paragraphs' vectors modulo 2^32. So paragraphs can be put
in, taken out or moved without reading the rest, and documents of the same paragraphs, in whatever
order, have the same fingerprint.

* The first PROOF lanes are two SHA-256 digests of the paragraph: they tell multisets apart.
* The other LIKE lanes are a count sketch of the paragraph's windows, one for each code point with up
  to WINDOW - 1 before it: the window's hash names a lane and a sign. Sums of sketches are sketches of
  the sums, and their cosine estimates that of the documents' window counts (the error is about
  1 / sqrt(LIKE)), so fingerprints also say how alike documents are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import ORACLES, query

PROOF, LIKE, WINDOW = 16, 128, 8
LANES = PROOF + LIKE
#: Windows are hashed by a multilinear function modulo this prime, whose factors are digits of SHA-256.
PRIME = (1 << 31) - 1
FACTORS = [int(hashlib.sha256(f"window {i}".encode()).hexdigest()[:8], 16) % PRIME for i in range(WINDOW)]
#: Code points sketched at once.
STRIDE = 1 << 20
#: Ranges of ids that neighbours are looked for in: at most so many, of about so many rows.
MOST_RANGES, ROWS = 4096, 4096


def _sketch(text: str) -> np.ndarray:
    """The LIKE lanes of a text; line feeds become marks that no window reaches across."""
    spread = np.frombuffer(text.replace("\n", "\n" * (WINDOW - 1)).encode("utf-32-le", "surrogatepass"), "<u4")
    counts = np.zeros(2 * LIKE, dtype=np.int64)
    for start in range(0, len(spread), STRIDE):
        part = spread[max(0, start - WINDOW + 1): start + STRIDE].astype(np.uint64)
        fresh = part if start == 0 else part[WINDOW - 1:]
        real = fresh != 10
        code = np.where(part == 10, 0, part + 1).astype(np.uint64)
        if start == 0:
            code = np.concatenate([np.zeros(WINDOW - 1, np.uint64), code])
        total = np.zeros(len(fresh), np.uint64)
        for i, factor in enumerate(FACTORS):  # the i-th code point before the window's end
            at = WINDOW - 1 - i
            total += np.uint64(factor) * code[at: at + len(fresh)]
        places = (total % np.uint64(PRIME))[real] % np.uint64(2 * LIKE)
        counts += np.bincount(places.astype(np.int64), minlength=2 * LIKE)
    return counts[:LIKE] - counts[LIKE:]


def vector(text: str | None) -> np.ndarray:
    """The sum of the vectors of a text's paragraphs; zero for the empty text."""
    if not text:
        return np.zeros(LANES, np.uint32)
    digests = []
    for paragraph in text.split("\n"):
        data = paragraph.encode("utf-8", "surrogatepass")
        digests += [hashlib.sha256(b"0" + data).digest(), hashlib.sha256(b"1" + data).digest()]
    proof = np.frombuffer(b"".join(digests), ">u4").reshape(-1, PROOF).sum(axis=0, dtype=np.uint32)
    return np.concatenate([proof, (_sketch(text) % (1 << 32)).astype(np.uint32)])


def shown(lanes: np.ndarray) -> str:
    """Eight hex digits for every lane."""
    return lanes.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Cosine of two fingerprints' sketches, 0 where it is negative; 1 for equal ones, empty ones included."""
    a, b = (x[PROOF:].astype(np.int32).astype(np.int64) for x in (one, other))
    if (a == b).all():
        return 1.0
    size = float((a * a).sum()) * float((b * b).sum())
    return min(1.0, max(0.0, float((a * b).sum()) / float(np.sqrt(size)))) if size else 0.0


def fingerprints(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(``row_id``, n_chars, fingerprint), a row for each row, without a shuffle.

    NULL texts are empty ones; the empty text's fingerprint is zero. Ids may be NULL or repeated. An
    empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([shown(vector(t)) for t in texts], pa.string()),
            ], names=[row_id, "n_chars", "fingerprint"])

    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), common.whole(text).alias("text"))
    return rows.mapInArrow(run, f"`{row_id}` bigint, n_chars bigint, fingerprint string")


def updated(
    prints: DataFrame, changes: DataFrame, row_id: str = "doc_id", paragraph: str = "paragraph", inserted: str = "inserted",
) -> DataFrame:
    """(``row_id``, fingerprint) after putting in (``inserted``) or taking out paragraphs; texts are not needed.

    ``changes`` has a row for each change. Changes of a document are summed up within every task before
    they are shuffled, so a document with a third of all changes costs one row per task. Documents that
    only ``changes`` names start empty. NULL paragraphs are empty ones; changes with a NULL id or
    kind are left out. A ``paragraph`` with line feeds counts as several. ``prints`` needs distinct
    ids; those without changes stay as they are.
    """
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[int, np.ndarray] = {}
            for key, text, put in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "put"))):
                # the paragraph as a text of its own; the empty one is a paragraph here
                lanes = vector(text) if text else _BLANK
                sums[key] = sums.get(key, np.zeros(LANES, np.uint32)) + (lanes if put else -lanes)
            yield _lanes_batch(sums)

    def sum_lanes(rows: DataFrame) -> DataFrame:
        lanes = F.array(*[F.pmod(F.sum(F.col("lanes")[i]), F.lit(1 << 32)) for i in range(LANES)])
        return rows.groupBy("id").agg(lanes.alias("lanes"))

    schema = "id bigint, lanes array<bigint>"
    some = changes.select(
        F.col(row_id).cast("bigint").alias("id"), common.whole(paragraph).alias("text"), F.col(inserted).alias("put")
    ).filter("id is not null and put is not null")
    old = prints.select(F.col(row_id).cast("bigint").alias("id"), lanes_of(F.col("fingerprint")).alias("lanes"))
    new = sum_lanes(old.unionByName(sum_lanes(some.mapInArrow(summed, schema))))
    digits = F.transform("lanes", lambda x: F.lower(F.lpad(F.hex(x), 8, "0")))
    return new.select(F.col("id").alias(row_id), F.array_join(digits, "").alias("fingerprint"))


_BLANK = np.concatenate([
    np.frombuffer(hashlib.sha256(b"0").digest() + hashlib.sha256(b"1").digest(), ">u4").astype(np.uint32),
    np.zeros(LIKE, np.uint32),
])


def lanes_of(fingerprint: Column) -> Column:
    """A shown fingerprint's lanes."""
    places = F.sequence(F.lit(0), F.lit(LANES - 1))
    return F.transform(places, lambda i: F.conv(F.substr(fingerprint, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint"))


def _lanes_batch(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = np.concatenate([v.astype(np.int64) for v in sums.values()]) if sums else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * LANES), pa.array(values))
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), lists], names=["id", "lanes"])


def _ranged(rows: DataFrame) -> DataFrame | None:
    """``rows`` (id, text) with a ``range`` of ids each, and every range's successor once more (``ahead``).

    Ranges are cut at ids of the table, so the first row of each is known, and so is the row that
    follows the range before it; the first row of all follows the last range. None for an empty table.
    """
    many = rows.count()
    if not many:
        return None
    ranges = max(1, min(MOST_RANGES, many // ROWS))
    asked = F.percentile_approx("id", [i / ranges for i in range(1, ranges)] or [0.5], 20 * ranges)
    found = rows.agg(asked.alias("cuts"), F.min("id").alias("least"), F.count("id").alias("known")).first()
    cuts = sorted({c for c in (found["cuts"] or []) if ranges > 1 and (c > found["least"] or found["known"] < many)})
    tie = F.xxhash64("text")
    first_id = None if found["known"] < many else found["least"]
    starts = rows.filter(F.col("id").isin(cuts) | F.col("id").eqNullSafe(F.lit(first_id).cast("bigint")))
    least = {row["id"]: row["tie"] for row in starts.groupBy("id").agg(F.min(tie).alias("tie")).collect()}
    # two levels of at most 64 cuts each instead of a walk over all of them
    wide = 64
    groups = [cuts[i: i + wide] for i in range(0, len(cuts), wide)]
    coarse = F.array(*[F.lit(g[0]).cast("bigint") for g in groups]).cast("array<bigint>")
    fine = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in g]) for g in groups])
    if cuts:
        group = F.size(F.filter(coarse, lambda c: c <= F.col("id")))
        within = F.size(F.filter(F.element_at(fine, F.greatest(group, F.lit(1))), lambda c: c <= F.col("id")))
        place = F.when(group > 0, (group - 1) * wide + within).otherwise(0)
    else:
        place = F.lit(0)
    begins = [(0, first_id)] + [(i + 1, c) for i, c in enumerate(cuts)]
    known = rows.sparkSession.createDataFrame(
        [((b - 1) % len(begins), c, least[c]) for b, c in begins], "before int, _first bigint, _tie bigint"
    )
    rows = common.barrier(rows, tie=tie, place=F.coalesce(place, F.lit(0)).cast("int"))
    # the rows that begin a range also go to the range before; there are as many of these as ranges
    again = rows.join(F.broadcast(known), F.col("id").eqNullSafe(F.col("_first")) & (F.col("tie") == F.col("_tie")))
    return rows.select("id", "text", "tie", F.col("place").alias("range"), F.lit(False).alias("ahead")).union(
        again.select("id", "text", "tie", F.col("before").alias("range"), F.lit(True).alias("ahead"))
    )


def compared_with_edits(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """(``row_id``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text is the row's own with its last floor(n_chars / 2) code points replaced by the first
    as many, or all, of the next row's. Rows follow each other by id, NULL first, those of one id by the
    64-bit hash of their text (equal texts of one id in any order, which makes no difference); the first
    follows the last, so a single row follows itself. NULL texts are empty ones. An empty table gives
    an empty result; columns besides the two are not read.

    Rows are shuffled once, into ranges of ids in which a task walks the sorted rows holding two at a
    time, however many there are.
    """
    schema = (
        f"`{row_id}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    rows = docs.select(F.col(row_id).cast("bigint").alias("id"), common.whole(text).alias("text"))
    ranged = _ranged(rows)
    if ranged is None:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("range", "ahead", "id", "text")]
            for place, ahead, key, own in zip(*columns):
                if last is not None and last[0] == place and last[1]:
                    continue  # equal rows that begin the next range: the first of them was enough
                lanes = vector(own)
                if last is not None and last[0] == place:
                    out.append(_compared(last[2], last[3], last[4], own, lanes))
                last = (place, ahead, key, own, lanes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(_KINDS)],
                names=[row_id, *schema_names],
            )

    schema_names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    dealt = ranged.repartition("range").sortWithinPartitions("range", "ahead", F.col("id").asc_nulls_first(), "tie")
    return dealt.select("range", "ahead", "id", "text").mapInArrow(run, schema)


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compared(key: int | None, own: str, lanes: np.ndarray, after: str, after_lanes: np.ndarray) -> tuple:
    cut = len(own) // 2
    edited = own[: len(own) - cut] + after[:cut]
    edited_lanes = vector(edited)
    return (
        key, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), shown(lanes), shown(edited_lanes),
        likeness(lanes, edited_lanes), likeness(lanes, after_lanes),
    )


@query("op13_multiset_fingerprint")
def op13_multiset_fingerprint(spark, sf):
    return compared_with_edits(common.table(spark, sf, "documents"))


_PROOF_SQL = ", ".join(
    f"coalesce(sum(('0x' || substr(sha256('{i // 8}' || paragraph), {i % 8 * 8 + 1}, 8))::bigint), 0) % 4294967296 as p{i}"
    for i in range(PROOF)
)
_WINDOW_SQL = " + ".join(
    f"{f} * coalesce(lag(code, {i}) over one, 0)" if i else f"{f} * code" for i, f in enumerate(FACTORS)
)
ORACLES["op13_multiset_fingerprint"] = f"""
with ordered as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n_chars,
         row_number() over (order by doc_id nulls first) as r, count(*) over () as n
  from documents
), pairs as (
  select a.r, a.doc_id, a.n_chars, a.text, b.r as next_r,
         substr(a.text, 1, a.n_chars - a.n_chars // 2) || substr(b.text, 1, a.n_chars // 2) as edited
  from ordered a join ordered b on b.r = a.r % a.n + 1
), texts as (
  select r * 2 as t, text from pairs union all select r * 2 + 1, edited from pairs
), paragraphs as (
  select t, unnest(string_split(text, chr(10))) as paragraph, generate_subscripts(string_split(text, chr(10)), 1) as k
  from texts where text <> ''
), proofs as (
  select t, {_PROOF_SQL} from texts left join paragraphs using (t) group by t
), codes as (
  select t, k, i, unicode(c)::bigint + 1 as code from (
    select t, k, unnest(string_split(paragraph, '')) as c, generate_subscripts(string_split(paragraph, ''), 1) as i
    from paragraphs where paragraph <> '')
), hashed as (
  select t, (({_WINDOW_SQL}) % {PRIME}) % {2 * LIKE} as h from codes
  window one as (partition by t, k order by i)
), lanes as (
  select t, h % {LIKE} as lane, sum(case when h < {LIKE} then 1 else -1 end)::bigint as v from hashed group by t, h % {LIKE}
), filled as (
  select t, lane, coalesce(v, 0) as v from (select t, unnest(range({LIKE})) as lane from texts) left join lanes using (t, lane)
), sketches as (
  select t, list(v order by lane) as vs, sum(v * v)::double as size,
         string_agg(printf('%08x', (v + 4294967296) % 4294967296), '' order by lane) as digits
  from filled group by t
), prints as (
  select t, concat({", ".join(f"printf('%08x', p{i}::bigint)" for i in range(PROOF))}, digits) as print, vs, size
  from proofs join sketches using (t)
)
select p.doc_id, p.n_chars::bigint as n_chars, sha256(p.edited) as edited_sha256, a.print as fingerprint,
       e.print as edited_fingerprint,
       case when a.vs = e.vs then 1.0 when a.size * e.size = 0 then 0.0
            else least(1.0, greatest(0.0, list_sum(list_transform(list_zip(a.vs, e.vs), lambda x: x[1] * x[2]))::double
                 / sqrt(a.size * e.size))) end::double as near_edited,
       case when a.vs = b.vs then 1.0 when a.size * b.size = 0 then 0.0
            else least(1.0, greatest(0.0, list_sum(list_transform(list_zip(a.vs, b.vs), lambda x: x[1] * x[2]))::double
                 / sqrt(a.size * b.size))) end::double as near_next
from pairs p join prints a on a.t = p.r * 2 join prints e on e.t = p.r * 2 + 1 join prints b on b.t = p.next_r * 2
"""
