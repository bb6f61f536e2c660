"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label that have a cosine of at least ``least`` are, scaled to length one, at most
eps = sqrt(2 - 2 least) apart, and so are their coordinates along any orthonormal axes. The axes are
the leading principal directions of a sample; the vectors are sorted by the grid cells (of width eps)
they fall into, cut into blocks of consecutive vectors, and intervals of blocks are joined
recursively: a pair of intervals whose bounding boxes are more than eps apart is skipped with
everything in it, others are split. The surviving pairs of blocks are compared exactly.

The sample only chooses the axes, so results do not depend on it. Copies enter once, with their
number. A pair of blocks returns links counted per vector, and for the components only a forest of
its links, so a dense cluster does not return all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query
from sightline.operators import lists

LEAST = 0.93
#: Vectors in a block, principal directions of the grid, intervals per interval above.
BLOCK, AXES, FAN = 256, 6, 8
#: Vectors that the axes are fitted on.
SAMPLE = 4096


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, also those whose squares leave the range of doubles."""
    with np.errstate(over="ignore"):
        length = np.linalg.norm(x, axis=1, keepdims=True)
    odd = ~((length > 1e-140) & (length < 1e140))
    if odd.any():
        x = np.where(odd, x / np.abs(x).max(axis=1, keepdims=True), x)
        length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / length


def axes(sample: list[list[float]], n: int) -> np.ndarray:
    """Leading principal directions as rows; the first coordinates where there is no sample."""
    x = _unit(np.array(sample, dtype=float))
    found = np.linalg.svd(x - x.mean(axis=0), full_matrices=True)[2]
    return found[:n]


def _projected(by_size: dict[int, np.ndarray], eps: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells, places = [], []
            for v in batch["v"]:
                x = _unit(np.array([v], dtype=float))[0]
                found = by_size.get(len(x))
                at = found @ x if found is not None else x[:AXES]
                at = np.concatenate([at, np.zeros(AXES - len(at))])
                places.append(at.tolist())
                cells.append(np.floor(at / eps).astype(int).tolist())
            yield batch.assign(place=places, cell=cells)
    return run


def _matrix(rows: pd.Series) -> np.ndarray:
    return _unit(np.array([list(v) for v in rows], dtype=float))


def _forest(near: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Links (node, least node) that join what the links of a block of the adjacency matrix join."""
    linked = near.any(axis=1)
    if not linked.any():
        return []
    near, rows = near[linked], rows[linked]
    used = near.any(axis=0)
    near, cols = near[:, used], cols[used]
    label_r = rows.copy()
    label_c = cols.copy()
    most = np.iinfo(np.int64).max
    while True:
        down = np.minimum(label_r, np.where(near, label_c[None, :], most).min(axis=1))
        across = np.minimum(label_c, np.where(near, down[:, None], most).min(axis=0))
        if (down == label_r).all() and (across == label_c).all():
            break
        label_r, label_c = down, across
    pairs = set(zip(rows.tolist(), label_r.tolist())) | set(zip(cols.tolist(), label_c.tolist()))
    return [(a, b) for a, b in pairs if a != b]


def _compared(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, links, others = [], [], []
            for row in batch.itertuples():
                own = [np.frombuffer(x, "<f8") for x in (row.m1, row.m2)]
                ids = [np.frombuffer(x, "<i8") for x in (row.ids1, row.ids2)]
                copies = [np.frombuffer(x, "<i8") for x in (row.n1, row.n2)]
                a, b = own[0].reshape(len(ids[0]), -1), own[1].reshape(len(ids[1]), -1)
                near = a @ b.T >= least
                if row.b1 == row.b2:
                    np.fill_diagonal(near, False)
                for n, node in ((near @ copies[1], ids[0]), (near.T @ copies[0], ids[1])):
                    some = np.flatnonzero(n)
                    nodes += node[some].tolist()
                    links += n[some].tolist()
                    others += [None] * len(some)
                    if row.b1 == row.b2:
                        break
                for x, y in _forest(near, *ids):
                    nodes.append(x)
                    links.append(0)
                    others.append(y)
            yield pd.DataFrame({"node": nodes, "n": links, "other": pd.array(others, dtype="Int64")})
    return run


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    return pd.DataFrame({
        "space": [rows["space"].iloc[0]], "b": [rows["b"].iloc[0]],
        "ids": [rows["node"].to_numpy("<i8").tobytes()], "n": [rows["n"].to_numpy("<i8").tobytes()],
        "m": [_matrix(rows["v"]).astype("<f8").tobytes()],
    })


def _apart(x: str, y: str) -> Column:
    """Squared distance of two bounding boxes (columns lo and hi of aliases x and y)."""
    out = F.lit(0.0)
    for i in range(AXES):
        lo = F.greatest(F.col(f"{x}.lo")[i], F.col(f"{y}.lo")[i])
        hi = F.least(F.col(f"{x}.hi")[i], F.col(f"{y}.hi")[i])
        gap = F.greatest(lo - hi, F.lit(0.0))
        out = out + gap * gap
    return out


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(space, b1 <= b2): the pairs of blocks that are not provably apart.

    ``blocks`` has space, b and the box (lo, hi). The boxes of FAN consecutive intervals make the
    next level's, up to one interval per space; then pairs are split level by level downwards.
    """
    levels = [blocks]
    highest = blocks.agg(F.max("b")).first()[0] or 0
    while highest > 0:
        highest //= FAN
        last = levels[-1].withColumn("b", F.floor(F.col("b") / FAN))
        mins = [F.min(F.col("lo")[i]) for i in range(AXES)]
        maxs = [F.max(F.col("hi")[i]) for i in range(AXES)]
        levels.append(common.stored(
            last.groupBy("space", "b").agg(F.array(*mins).alias("lo"), F.array(*maxs).alias("hi")), "grid-boxes"
        ))
    pairs = levels[-1].select("space", F.col("b").alias("b1"), F.col("b").alias("b2"))
    limit = eps * eps * (1 + 1e-9) + 1e-9
    for boxes in reversed(levels[:-1]):
        part = F.sequence(F.lit(0), F.lit(FAN - 1))
        split = (
            pairs.select("space", "b1", "b2", F.explode(part).alias("i"))
            .select("space", (F.col("b1") * FAN + F.col("i")).alias("b1"), "b2", F.explode(part).alias("j"))
            .select("space", "b1", (F.col("b2") * FAN + F.col("j")).alias("b2")).filter("b1 <= b2")
        )
        left, right = boxes.alias("x"), boxes.alias("y")
        kept = (
            split.alias("p")
            .join(left, (F.col("p.space") == F.col("x.space")) & (F.col("p.b1") == F.col("x.b")))
            .join(right, (F.col("p.space") == F.col("y.space")) & (F.col("p.b2") == F.col("y.b")))
            .filter(_apart("x", "y") <= limit)
        )
        pairs = common.stored(kept.select("p.space", "p.b1", "p.b2"), "grid-pairs")
    return pairs


def near_duplicates(
    vectors: DataFrame, vector: str = "embedding", row_id: str = "vec_id", label: str = "label", least: float = LEAST,
) -> DataFrame:
    """(``row_id``, n_links, component_id, kept), a row for each row; ``row_id`` is a bigint.

    Rows link whose labels are equal and whose vectors have a cosine of ``least`` or more, in double
    precision. n_links counts the other rows linked directly, copies and repeated ids included;
    component_id is the smallest id reachable, the own included; kept says that it is the own. Rows
    with a NULL label, and vectors that are NULL, empty, zero or hold a NULL or non-finite
    component, link with nothing; vectors of different lengths do not link. Rows with NULL ids
    link like others and are not kept; a component in which all ids are NULL has the id NULL. An empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(row_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    rows = common.stored(rows, "grid-rows")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    distinct = common.stored(
        rows.filter(valid).groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "grid-distinct"
    )
    # one space per label and length
    entered = distinct.select(
        F.concat_ws(":", F.size("v"), "label").alias("space"), "v", "node", "n"
    )
    sample = entered.orderBy(F.xxhash64("v"), "node").limit(SAMPLE).select("v").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["v"]), []).append(row["v"])
    fitted = {size: axes(found, AXES) for size, found in by_size.items()}
    eps = float(np.sqrt(2 - 2 * least))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in entered.schema)}, place array<double>, cell array<int>"
    placed = common.stored(entered.mapInPandas(_projected(fitted, eps), schema), "grid-places")
    cells = [F.col("cell")[i] for i in range(AXES)]
    ordered = lists.with_positions(placed, "space", [*cells, F.col("node")]).withColumn(
        "b", F.floor(F.col("position") / BLOCK)
    )
    ordered = common.stored(ordered.drop("position", "cell"), "grid-sequence")
    lo = F.array(*[F.min(F.col("place")[i]) for i in range(AXES)])
    hi = F.array(*[F.max(F.col("place")[i]) for i in range(AXES)])
    boxes = common.stored(ordered.groupBy("space", "b").agg(lo.alias("lo"), hi.alias("hi")), "grid-boxes")
    pairs = _block_pairs(boxes, eps)
    packed = common.stored(
        ordered.groupBy("space", "b").applyInPandas(_packed, "space string, b bigint, ids binary, n binary, m binary"),
        "grid-blocks",
    )
    one = packed.select("space", *[F.col(c).alias(f"{c}1") for c in ("b", "ids", "n", "m")])
    two = packed.select("space", *[F.col(c).alias(f"{c}2") for c in ("b", "ids", "n", "m")])
    compared = pairs.join(one, ["space", "b1"]).join(two, ["space", "b2"])
    links = common.stored(compared.mapInPandas(_compared(least), "node bigint, n bigint, other bigint"), "grid-links", 64)
    counted = links.groupBy("node").agg(F.sum("n").alias("links"))
    found = common.components(
        links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")), "grid-edges"
    )
    ids = common.smallest_ids(distinct.select("node", "least"), found, "grid-components")
    classes = distinct.join(counted, "node", "left").join(ids, "node").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    classes = common.stored(classes, "grid-classes")
    own = F.coalesce("component_id", "vec_id")
    return rows.join(classes, ["label", "v"], "left").select(
        F.col("vec_id").alias(row_id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


@query("op2_embedding_grid_join")
def op2_embedding_grid_join(spark, sf):
    return near_duplicates(common.table(spark, sf, "embeddings"))
