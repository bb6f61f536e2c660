"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries enter as integers x = floor(1024 c) + 100000, so sums and centred sums of squares are exact.
The scatter of the centred vectors is factored as L L^T with diagonal pivoting, stopping at its rank.
Rotating pairs of columns of L until all are orthogonal leaves U diag(s): the squared norms are the
scatter's eigenvalues and the normalised columns its components. The scatter is never diagonalised
itself, so small eigenvalues keep their relative accuracy.

The table is read four times and its vectors are never shuffled: for the sums, for the scatter, for
the covariance of the result, and for the result. Tasks return matrices of (dimensions)^2 numbers;
their sum is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm import common
from sightline.llm.registry import query

COMPONENTS = 8
SCALE, OFFSET = 1024.0, 100_000
#: Entries beyond this enter as this: floor(1024 c) stays an exact integer of double precision.
MOST = 2.0**52
#: Halves of an integer that are summed apart, so that no sum can overflow.
HALF = 1 << 26
SWEEPS, SETTLED = 60, 1e-15
#: Rounding errors of a diagonal entry, in units of (dimensions x machine precision x the entry).
ROUNDING = 16
RESULT = (
    "{id} bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integers as doubles) of the usable vectors, a matrix for each length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # NULL entries become NaN
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == size)
        values = flat[starts[rows][:, None] + np.arange(size)]
        usable = np.isfinite(values).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(values[usable] * SCALE), -MOST, MOST) + OFFSET
        yield rows[usable], x


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for rows, x in _by_length(batch.column("v")):
            kept = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64), np.zeros(x.shape[1], np.int64)])
            whole = x.astype(np.int64)
            kept[0] += len(rows)
            kept[1] += (whole // HALF).sum(axis=0)
            kept[2] += (whole % HALF).sum(axis=0)
    for size, (n, high, low) in found.items():
        yield pa.RecordBatch.from_pydict({
            "size": pa.array([size] * size, pa.int32()), "i": pa.array(range(size), pa.int32()),
            "n": pa.array([n] * size, pa.int64()), "high": pa.array(high), "low": pa.array(low),
        })


class Centre:
    """Exact means S/n, held as whole part and remainder."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.size = n, len(sums)
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return (x.astype(np.int64) - self.whole).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2 over the dimensions, None where it is no 64-bit integer."""
        away = x.astype(np.int64) - self.whole
        about = ((self.n * away.astype(float) - self.rest) ** 2).sum(axis=1)
        small = about < 2.0**62  # then no product or sum below leaves 64 bits
        exact = np.zeros(len(x), dtype=np.int64)
        exact[small] = ((self.n * away[small] - self.rest) ** 2).sum(axis=1)
        out: list[int | None] = exact.tolist()
        rest = self.rest.tolist()
        for k in np.flatnonzero(~small):
            total = None
            if about[k] < 2.0**64:
                total = sum((self.n * a - r) ** 2 for a, r in zip(away[k].tolist(), rest))
            out[k] = total if total is not None and total < 1 << 63 else None
        return out


def _matrix_sum(vectors: DataFrame, centre: Centre, shown: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of y y^T, where y = shown(centred row) has ``size`` entries."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _by_length(batch.column("v")):
                if x.shape[1] == centre.size:
                    y = shown(centre.centred(x))
                    total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "value": pa.array(total[i, j]),
        })

    parts = vectors.select("v").mapInArrow(partial, "i int, j int, value double")
    out = np.zeros((size, size))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        out[i, j] = out[j, i] = value
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L of full column rank with L L^T = ``a``, triangular up to the order of its rows.

    Every step takes the largest remaining diagonal entry. An entry that is rounding error of the one
    it began as counts as zero, and it ends when all are.
    """
    size = len(a)
    left, order = a.diagonal().copy(), np.arange(size)
    factor = np.zeros((size, size))
    error = ROUNDING * size * np.finfo(float).eps * left
    for k in range(size):
        left[left <= error] = 0.0
        at = k + int(np.argmax(left[order[k:]]))
        order[[k, at]] = order[[at, k]]
        pivot, below = order[k], order[k + 1:]
        if left[pivot] <= 0:
            return factor[:, :k]
        factor[pivot, k] = np.sqrt(left[pivot])
        factor[below, k] = (a[below, pivot] - factor[below, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[below] -= factor[below, k] ** 2
    return factor


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit components as columns) of ``factor`` times its transpose.

    Columns are paired off as in a round-robin tournament; the disjoint pairs of a round are rotated
    at once. It ends with a sweep in which all pairs are orthogonal to working precision.
    """
    g = factor.copy()
    many = g.shape[1]
    seats = np.arange(many + many % 2)
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            p, q = seats[:half], seats[half:][::-1]
            real = (p < many) & (q < many)
            p, q = p[real], q[real]
            x, y = g[:, p], g[:, q]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            due = np.abs(c) > SETTLED * np.sqrt(a * b)
            if due.any():
                turned = True
                a, b, c, x, y = a[due], b[due], c[due], x[:, due], y[:, due]
                zeta = (b - a) / (2 * c)
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                g[:, p[due]], g[:, q[due]] = cos * x - cos * t * y, cos * t * x + cos * y
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    components = g[:, order] / norms[order]
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(many)])
    return norms[order] ** 2, components * signs


def whiten(
    vectors: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = COMPONENTS,
) -> DataFrame:
    """(``row_id``, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Rows whose vector is NULL, empty or holds a NULL or non-finite entry are dropped, and so are those
    whose vector is not of the most frequent length (of several, the longest). Entries c become
    x = floor(1024 c) + 100000 (1024 c is held within 2^52 on either side). ``whitened`` is x - S/n
    along the component over the root of its eigenvalue e, ``explained`` e over the covariance's
    trace, ``deviation`` the sum of (n x - S)^2, NULL if that is no 64-bit integer; ``identity_error``
    is the largest entry of the covariance of ``whitened``, measured over all rows, minus the identity.

    There are as many components as asked for, but no more than the covariance's rank: equal rows
    only, or one row, give none, and an empty table gives an empty result. Ids may be NULL or repeated;
    every row counts, copies too. Equal eigenvalues leave the choice of their components open, but one
    run uses the same for all rows. Columns besides the two are not read.
    """
    spark = vectors.sparkSession
    schema = RESULT.format(id=f"`{row_id}`")
    vectors = vectors.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    parts = common.stored(
        vectors.select("v").mapInArrow(_sums, "size int, i int, n bigint, high bigint, low bigint"), "whitening-sums", 10_000
    )
    common_size = (
        parts.filter("i = 0").groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    )
    if common_size is None:
        return spark.createDataFrame([], schema)
    totals = parts.filter(F.col("size") == common_size["size"]).groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")
    ).orderBy("i").collect()
    n = common_size["n"]
    centre = Centre(n, [row["high"] * HALF + row["low"] for row in totals])
    scatter = _matrix_sum(vectors, centre, lambda z: z, centre.size)
    trace = float(scatter.trace()) / n
    values, axes = one_sided_jacobi(pivoted_cholesky(scatter))
    kept = min(components, len(values))
    if not kept:
        return spark.createDataFrame([], schema)
    values = values[:kept] / n
    turn = axes[:, :kept] / np.sqrt(values)
    error = float(np.abs(_matrix_sum(vectors, centre, lambda z: z @ turn, kept) / n - np.eye(kept)).max())
    explained = values / trace

    def result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column("v")):
                if x.shape[1] != centre.size:
                    continue
                many = len(rows)
                each = pa.array(np.repeat(np.arange(many), kept))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(rows)).take(each),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * kept, n, dtype=np.int64)),
                    pa.array(centre.deviations(x), pa.int64()).take(each),
                    pa.array((centre.centred(x) @ turn).ravel()),
                    pa.array(np.tile(explained, many)), pa.array(np.full(many * kept, error)),
                ], names=[row_id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(result, schema)


@query("op11_whitening")
def op11_whitening(spark, sf):
    return whiten(common.table(spark, sf, "embeddings"))
