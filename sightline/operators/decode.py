"""JSON lines to typed rows, with everything undecodable kept in quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def nonempty(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that hold something, if only spaces."""
    return lines.filter(F.col(value) != "")


def decode_json(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Add one column per field, and the raw line in ``_corrupt`` when it does not decode.

    Fields are matched by name; unknown ones are ignored and missing ones are NULL. Numbers
    may come quoted. A line is corrupt when it is not one JSON object, or when a value does
    not fit its field; so is a line of spaces. Empty lines are dropped. A NULL line is corrupt
    and stands in ``_corrupt`` as the empty text, which no other line does.
    """
    target = T.StructType.fromDDL(schema)
    names = {f.name for f in target}
    as_text = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in target] + [T.StructField(CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [c for c in lines.columns if c not in names]
    line = F.col(value)

    def typed(row):
        """Casts and the corrupt mark of one parsed line, as one struct."""
        fields, misfit = [], F.lit(False)
        for f in target:
            text = row.getField(f.name)
            if isinstance(f.dataType, T.StringType):
                fields.append(text.alias(f.name))
            else:
                fitted = text.try_cast(f.dataType)
                fields.append(fitted.alias(f.name))
                misfit = misfit | (text.isNotNull() & fitted.isNull())
        bad = line.isNull() | ~F.ltrim(line).startswith("{") | row.getField(CORRUPT).isNotNull() | misfit
        return F.struct(*fields, F.when(bad, F.coalesce(line, F.lit(""))).alias(CORRUPT))

    # The generator parses and casts a line once. What follows sees plain columns: filters on
    # them stay above it, where a projection would let each of them parse the line again.
    # An empty line has nothing to generate from, so it goes without a filter of its own.
    parsed = F.when(line.isNull() | (line != ""), F.array(F.from_json(line, as_text, options)))
    return lines.select(*[F.col(c) for c in kept], F.inline(F.transform(parsed, typed)))


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(decoded: DataFrame, value: str = "value") -> DataFrame:
    """The lines that did not decode, as they came."""
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias(value))
