"""Row predicates and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import schemas


def valid_entity(entity: Column, seconds: Column | None = None, now: Column | None = None) -> Column:
    """TRUE for an entity worth tracking; never NULL.

    It must be present, carry no marker, have 6 to 10 characters, and (when ``seconds`` is
    given) not be more than a day ahead of the clock.
    """
    low, high = schemas.ENTITY_LENGTH
    # One expression, so that the entity is computed once where it is itself an expression.
    good = entity.rlike(rf"\A[^{''.join(schemas.ENTITY_MARKERS)}]{{{low},{high}}}\z")
    if seconds is not None:
        clock = F.unix_timestamp(F.current_timestamp() if now is None else now)
        good = good & (seconds < clock + schemas.MAX_CLOCK_LEAD_SECONDS)
    return F.coalesce(good, F.lit(False))


def feature_present(feature: Column, reject_null_text: bool = False) -> Column:
    good = feature.isNotNull() & (feature != "")
    return good & (feature != schemas.NULL_FEATURE_TEXT) if reject_null_text else good


def route(delta: Column) -> Column:
    """Where a row goes by its last-seen delta.

    ``advance`` (> 0) goes to the state, the simple state and the late search, ``state``
    (= 0) to the state only, ``history`` (< -60) to the history feed, ``keep`` nowhere else.
    """
    return (
        F.when(delta > 0, "advance")
        .when(delta == 0, "state")
        .when(delta < -schemas.HISTORY_SECONDS, "history")
        .otherwise("keep")
    )


def present_features(df: DataFrame, column: str, reject_null_text: bool = False) -> DataFrame:
    return df.filter(feature_present(F.col(column), reject_null_text))
