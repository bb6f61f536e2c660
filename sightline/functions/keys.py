"""Row keys, padded codes, versions and tie-breakers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def random_hex_id() -> Column:
    """A random 32-digit id. Differs on every evaluation, so stored rows use ``name_uuid``."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def name_uuid(name: Column) -> Column:
    """The RFC 4122 version 3 (MD5) UUID of a name, lower case, without dashes."""
    digest = F.md5(name)
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    return F.concat(
        F.substring(digest, 1, 12),
        F.lit("3"),
        F.substring(digest, 14, 3),
        F.lower(F.hex(variant.bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8)).cast("bigint"))),
        F.substring(digest, 18, 15),
    )


def packed(*cols: Column) -> Column:
    """Fields joined by ``_`` with NULL written as ``null``, so no field ever shifts."""
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])


def zero_pad(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer input is kept whole (``lpad`` alone would cut it)."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def tiebreak(key: Column) -> Column:
    """A number in 0..998 that depends only on the key, so a replay gives the same version."""
    return (F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("bigint") % 999).cast("int")


def version_of(*digits: Column) -> Column:
    """Digit groups concatenated to one BIGINT; NULL if they do not form one."""
    return F.concat(*[d.cast("string") for d in digits]).try_cast("bigint")


def reverse_key(key: Column) -> Column:
    return F.reverse(key)


def bucket(value: Column, buckets: int) -> Column:
    """Remainder with the sign of the dividend: the unknown code -1 stays -1."""
    return value % buckets


def split_fields(line: Column, names: list[str]) -> list[Column]:
    """Fields of a comma line by position; missing ones are NULL."""
    parts = F.split(line, ",", -1)
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)]
