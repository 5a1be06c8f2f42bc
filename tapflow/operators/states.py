"""Partial states of counts by month: what sums, means and deviations of any months are made of.

A state row holds, for a month, station, hour and direction, the number of counts, their sum
and the sum of their squares. States of disjoint rows add up, so a month is counted once and
any set of months is merged without its facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

STATE_KEYS = ["station", "hour", "direction"]
STATE = "station string, hour int, direction string, n long, total long, squares decimal(38,0)"


def monthly_states(long: DataFrame) -> DataFrame:
    """year_month, station, hour, direction, n, total, squares. Null counts are not counted, but
    keep their keys."""
    count = F.col("count").cast("decimal(19,0)")
    return long.groupBy("year_month", *STATE_KEYS).agg(
        F.count("count").alias("n"), F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(count * count), F.lit(0)).cast("decimal(38,0)").alias("squares"),
    )


def merged_states(states: DataFrame, *keys: str) -> DataFrame:
    """States of the same keys added up."""
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").cast("decimal(38,0)").alias("squares")
    )


def states_as_long(states: DataFrame) -> DataFrame:
    """States in the shape of the long table, one count per state: operators that add counts up
    (hour totals, window sums, features, shares) give the same on these as on the facts."""
    return states.select(
        "year_month", F.lit(None).cast("string").alias("line"), "station", "hour", "direction", F.col("total").alias("count")
    )


def hour_totals_of(states: DataFrame) -> DataFrame:
    """As ``aggregates.hour_totals`` of the facts."""
    kept = states.where("station IS NOT NULL AND hour IS NOT NULL")
    return merged_states(kept, "station", "hour").select("station", "hour", F.when(F.col("n") > 0, F.col("total")).alias("taps"))


def hour_direction_mean_of(states: DataFrame) -> DataFrame:
    """As ``aggregates.hour_direction_mean`` of the facts, with the deviation over rows."""
    merged = merged_states(states.dropna(subset=STATE_KEYS), *STATE_KEYS)
    n = F.col("n")
    # n * squares - total² in whole numbers, which a difference of doubles would lose
    spread = n.cast("decimal(19,0)") * F.col("squares") - F.col("total").cast("decimal(19,0)") * F.col("total").cast("decimal(19,0)")
    return merged.select(
        *STATE_KEYS, F.try_divide("total", n).alias("mean_count"),
        F.try_divide(F.sqrt(spread.cast("double")), n).alias("std_count"), n.alias("n_rows"),
    )


def annual_totals_of(states: DataFrame) -> DataFrame:
    """As ``aggregates.annual_totals`` of the facts."""
    kept = states.dropna(subset=["station", "year_month"]).withColumn("year", F.year("year_month"))
    return merged_states(kept, "station", "year").select("station", "year", F.when(F.col("n") > 0, F.col("total")).alias("taps"))
