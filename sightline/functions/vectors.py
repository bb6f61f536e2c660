"""Feature vectors: byte checksums and squared distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UDF_NAME = "feature_distance"


def byte_sum(feature: Column) -> Column:
    """Sum of the unsigned bytes of a base64 feature; NULL when it is not base64."""
    return _binary_sum(_decoded(feature))


def byte_checksum(feature: Column) -> Column:
    return byte_sum(feature) % 1000


def squared_distance(left: Column, right: Column) -> Column:
    """Squared Euclidean distance of two numeric arrays as an expression; NULL for unequal lengths.

    Good for short arrays. Spark interprets the lambdas element by element, so from about a
    dozen elements on ``array_distance`` is faster (twice at 64).
    """
    gaps = F.zip_with(left, right, lambda a, b: (a - b).cast("double") * (a - b).cast("double"))
    total = F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g)
    return F.when(F.size(left) == F.size(right), total)


def _row_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``values``; an empty stretch sums to 0."""
    out = np.zeros(len(lengths), values.dtype)
    filled = lengths > 0
    if filled.any():
        starts = (np.cumsum(lengths) - lengths)[filled]
        out[filled] = np.add.reduceat(values, starts)
    return out


def _comparable(left: pa.Array, right: pa.Array, length) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have two vectors of one length, and those lengths."""
    same = pc.fill_null(pc.equal(length(left), length(right)), False)
    return same.to_numpy(zero_copy_only=False), pc.filter(length(left), same).to_numpy().astype(np.int64)


def _spread(sums: np.ndarray, good: np.ndarray, kind: pa.DataType) -> pa.Array:
    out = np.zeros(len(good), sums.dtype)
    out[good] = sums
    return pa.array(out, kind, mask=~good)


@F.arrow_udf(T.DoubleType())
def array_distance(left: pa.Array, right: pa.Array) -> pa.Array:
    """Squared distance of two numeric arrays, in one numpy pass over a batch's elements."""
    good, lengths = _comparable(left, right, pc.list_value_length)
    a, b = (pc.filter(side, pa.array(good)).flatten() for side in (left, right))
    gaps = a.to_numpy(zero_copy_only=False).astype(np.float64) - b.to_numpy(zero_copy_only=False).astype(np.float64)
    sums = _row_sums(gaps * gaps, lengths)
    if a.null_count or b.null_count:
        holes = pc.or_(a.is_null(), b.is_null()).to_numpy(zero_copy_only=False).astype(np.int64)
        whole = _row_sums(holes, lengths) == 0
        sums, good[good] = sums[whole], whole
    return _spread(sums, good, pa.float64())


def _bytes_of(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column behind each other."""
    joined = pa.concat_arrays([column])  # drops an offset into a larger buffer
    offsets = np.frombuffer(joined.buffers()[1], np.int64 if pa.types.is_large_binary(joined.type) else np.int32)
    data = joined.buffers()[2]
    first, last = offsets[joined.offset], offsets[joined.offset + len(joined)]
    return np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)


@F.arrow_udf(T.LongType())
def _binary_distance(left: pa.Array, right: pa.Array) -> pa.Array:
    """Squared distance of unsigned bytes, in one numpy pass over a batch's bytes."""
    good, lengths = _comparable(left, right, pc.binary_length)
    a, b = (_bytes_of(pc.filter(side, pa.array(good))).astype(np.int64) for side in (left, right))
    return _spread(_row_sums((a - b) ** 2, lengths), good, pa.int64())


@F.arrow_udf(T.LongType())
def _binary_sum(values: pa.Array) -> pa.Array:
    """Sum of unsigned bytes, in one numpy pass over a batch's bytes."""
    good = values.is_valid()
    lengths = pc.binary_length(values.drop_null()).to_numpy().astype(np.int64)
    found, out = _bytes_of(values.drop_null()), np.zeros(len(lengths), np.int64)
    filled = lengths > 0
    if filled.any():
        out[filled] = np.add.reduceat(found, (np.cumsum(lengths) - lengths)[filled], dtype=np.int64)
    return _spread(out, good.to_numpy(zero_copy_only=False).copy(), pa.int64())


def _decoded(feature: Column | str) -> Column:
    return F.try_to_binary(F.col(feature) if isinstance(feature, str) else feature, F.lit("base64"))


def byte_distance(left: Column | str, right: Column | str) -> Column:
    """Squared distance of two base64 features; NULL for unequal lengths or what is not base64.

    Spark decodes the text; Python sees plain bytes.
    """
    return _binary_distance(_decoded(left), _decoded(right))


def register(spark: SparkSession) -> str:
    """Make the distance of two base64 features callable from SQL and return its name."""
    spark.udf.register(f"{UDF_NAME}_of_bytes", _binary_distance)
    spark.sql(
        f"create or replace temporary function {UDF_NAME}(a string, b string) returns bigint return "
        f"{UDF_NAME}_of_bytes(try_to_binary(a, 'base64'), try_to_binary(b, 'base64'))"
    )
    return UDF_NAME
