"""Six ridership features per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapflow import fixed
from tapflow.functions.numbers import ratio_or_null, ratio_or_zero
from tapflow.operators.aggregates import dense_cv, spread_parts
from tapflow.operators.reshape import in_day
from tapflow.schemas import require_columns


def _sum_in(hours: list[int]) -> Column:
    return F.sum(F.when(F.col("hour").isin(hours), F.col("slot")).otherwise(0))


def _dense_max(hours: list[int]) -> Column:
    """Largest of the hours' sums, where an hour that does not occur counts as 0."""
    inside = F.when(F.col("hour").isin(hours), F.col("slot"))
    largest = F.max(inside)
    return F.when(F.count(inside) == len(hours), largest).otherwise(
        F.greatest(F.coalesce(largest, F.lit(0)), F.lit(0))
    )


def station_features(long: DataFrame) -> DataFrame:
    """One row per station; ``station_id`` is carried when present.

    One grouping by station and hour combines before the exchange (at most 24 rows per
    station and task); a second over those rows forms the day.
    """
    require_columns(long, ["station", "hour", "direction", "count"], "station_features")
    has_id = "station_id" in long.columns
    identity = [F.min("station_id").alias("station_id")] if has_id else []

    def directed(direction: str) -> Column:
        return F.sum(F.when(F.col("direction") == direction, F.col("count")).otherwise(0)).alias(direction)

    hourly = in_day(long, ["station"]).groupBy("station", "hour").agg(
        F.sum("count").alias("slot"), directed("board"), directed("alight"), *identity
    )
    in_morning = F.col("hour").isin(fixed.MORNING_HOURS)
    day = hourly.groupBy("station").agg(
        F.sum("slot").alias("total"),
        _dense_max(fixed.MORNING_HOURS).alias("morning_max"),
        _dense_max(fixed.EVENING_HOURS).alias("evening_max"),
        _sum_in(fixed.MORNING_HOURS).alias("morning"),
        _sum_in(fixed.EVENING_NIGHT_HOURS).alias("evening_night"),
        _sum_in(fixed.LATE_HOURS).alias("late"),
        F.sum(F.when(in_morning, F.col("board")).otherwise(0)).alias("boarded"),
        F.sum(F.when(in_morning, F.col("alight")).otherwise(0)).alias("alighted"),
        *spread_parts("slot"),
        *identity,
    )
    total, boarded, alighted = F.col("total"), F.col("boarded"), F.col("alighted")
    formulas = {
        "morning_peak_intensity": ratio_or_zero(F.col("morning_max"), total),
        "evening_peak_intensity": ratio_or_zero(F.col("evening_max"), total),
        "weekend_weekday_ratio": ratio_or_null(F.col("evening_night"), F.col("morning")),
        "late_night_share": ratio_or_zero(F.col("late"), total),
        "directional_asymmetry_peak": ratio_or_zero(alighted - boarded, alighted + boarded),
        "cv_hourly": dense_cv(),
    }
    return day.select(
        "station", *(["station_id"] if has_id else []),
        *[formulas[name].alias(name) for name in fixed.FEATURES],
    )


def is_complete() -> Column:
    """Whether all six features are defined."""
    complete = F.lit(True)
    for name in fixed.FEATURES:
        complete = complete & F.col(name).isNotNull() & ~F.isnan(name)
    return complete


def complete_features(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with all six features, and the rejected rest."""
    return features.where(is_complete()), features.where(~is_complete())


def feature_labels(features: DataFrame) -> DataFrame:
    """Long form: one row per station and feature with its place and label; ids are kept."""
    cells = [
        F.struct(
            F.lit(order).alias("feature_order"), F.lit(name).alias("feature"),
            F.lit(label).alias("label"), F.col(name).alias("value"),
        )
        for order, (name, label) in enumerate(zip(fixed.FEATURES, fixed.FEATURE_LABELS))
    ]
    identity = [name for name in ("station", "station_id") if name in features.columns]
    return features.select(*identity, F.inline(F.array(*cells)))
