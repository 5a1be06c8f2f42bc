"""Sums, means and shares by entity, hour, weekday and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow import fixed
from tapflow.functions.arrays import ordered_values
from tapflow.functions.numbers import ratio_or_null, ratio_or_zero, settled_round
from tapflow.functions.text import balance_label, column_label, signed_percent
from tapflow.operators.reshape import (
    dense_hours, hour_profile, in_day, slot_sums, slot_total, slots,
)


def hour_totals(long: DataFrame) -> DataFrame:
    """Taps by station and hour, only hours that occur."""
    keyed = long.where(F.col("station").isNotNull() & F.col("hour").isNotNull())
    return keyed.groupBy("station", "hour").agg(F.sum("count").alias("taps"))


def hour_direction_mean(long: DataFrame) -> DataFrame:
    """Mean count over the rows (months and lines) of a station, hour and direction."""
    keys = ["station", "hour", "direction"]
    return long.dropna(subset=keys).groupBy(*keys).agg(F.avg("count").alias("mean_count"))


def column_distinctiveness(long: DataFrame, top: int = fixed.DISTINCTIVE_COLUMNS) -> DataFrame:
    """Hour × direction columns ranked by their variation between stations.

    The final ranking window runs over one row per column, at most 48.
    """
    by_column = hour_direction_mean(long).groupBy("hour", "direction").agg(
        F.avg("mean_count").alias("mean"), F.stddev_pop("mean_count").alias("std")
    )
    measured = by_column.select(
        "hour", "direction",
        column_label(F.col("hour"), F.col("direction")).alias("column_label"),
        settled_round(F.col("mean"), 1).alias("mean_riders"),
        settled_round(F.col("std"), 1).alias("std_riders"),
        settled_round(
            F.when(F.col("mean") > 0, F.try_divide("std", "mean")).otherwise(0.0), 4
        ).alias("cv"),
    )
    order = Window.orderBy(F.desc("cv"), "hour", "direction")
    return measured.withColumn("rank", F.row_number().over(order)).withColumn(
        "distinctive", F.col("rank") <= top
    )


def weekday_mean(daily: DataFrame) -> DataFrame:
    """Mean daily volume by station and weekday over the daily rows, 7 rows per station."""
    means = daily.where(F.col("station").isNotNull()).groupBy("station", "weekday").agg(
        F.avg(F.col("board_total") + F.col("alight_total")).alias("mean_taps")
    )
    days = [
        F.coalesce(F.max(F.when(F.col("weekday") == day, F.col("mean_taps"))), F.lit(0.0))
        for day in range(7)
    ]
    dense = means.groupBy("station").agg(F.array(*days).alias("days"))
    return dense.select("station", F.posexplode("days").alias("weekday", "mean_taps"))


def hour_share(long: DataFrame) -> DataFrame:
    """Share of each hour in the station's total, 24 rows; stations without taps are left out."""
    profile = hour_profile(long, ["station"]).withColumn("total", slot_total()).where("total <> 0")
    rows = dense_hours(profile, ["station", "total"])
    return rows.select("station", "hour", "taps", (F.col("taps") / F.col("total")).alias("share"))


def weekday_hour_surface(long: DataFrame, daily: DataFrame,
                         stations: list[str] | None = None) -> DataFrame:
    """Estimated taps by station, weekday and hour: weekday mean × hour share.

    Without a list the stations found in both tables count; a listed station that the
    daily table lacks gets zeros.
    """
    how = "inner"
    if stations is not None:
        wanted = F.col("station").isin(list(stations))
        long, daily, how = long.where(wanted), daily.where(wanted), "left"
    profile = hour_profile(long, ["station"]).withColumn("total", slot_total()).where("total <> 0")
    shares = profile.select(
        "station", F.array(*[slot / F.col("total") for slot in slots()]).alias("shares")
    )
    days = weekday_mean(daily).groupBy("station").agg(
        ordered_values(F.col("weekday"), F.col("mean_taps")).alias("days")
    )
    zeros = F.array_repeat(F.lit(0.0), 7)
    both = shares.join(days, "station", how).withColumn("days", F.coalesce("days", zeros))
    by_day = both.select("station", "shares", F.posexplode("days").alias("weekday", "mean_taps"))
    by_hour = by_day.select("station", "weekday", "mean_taps", F.posexplode("shares").alias("hour", "share"))
    return by_hour.select("station", "weekday", "hour", (F.col("mean_taps") * F.col("share")).alias("value"))


def _sum_when(condition: Column, value: str = "taps") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0))


def window_sums(long: DataFrame) -> DataFrame:
    """Taps in the morning, evening, late and evening-to-night windows and AM direction sums."""
    hour, direction = F.col("hour"), F.col("direction")
    grouped = in_day(long, ["station"]).groupBy("station", "hour", "direction").agg(
        F.sum("count").alias("taps")
    )
    morning = hour.isin(fixed.MORNING_HOURS)
    return grouped.groupBy("station").agg(
        _sum_when(morning).alias("morning_taps"),
        _sum_when(hour.isin(fixed.EVENING_HOURS)).alias("evening_taps"),
        _sum_when(hour.isin(fixed.LATE_HOURS)).alias("late_taps"),
        _sum_when(hour.isin(fixed.EVENING_NIGHT_HOURS)).alias("evening_night_taps"),
        _sum_when(morning & (direction == "board")).alias("morning_board"),
        _sum_when(morning & (direction == "alight")).alias("morning_alight"),
    )


def annual_totals(long: DataFrame) -> DataFrame:
    """Taps by station and calendar year."""
    year = F.year("year_month").alias("year")
    keyed = long.dropna(subset=["station", "year_month"])
    return keyed.groupBy("station", year).agg(F.sum("count").alias("taps"))


def weekend_balance(daily: DataFrame) -> DataFrame:
    """Weekend mean over weekday mean − 1 by station, with its label and text."""
    total = F.col("board_total") + F.col("alight_total")
    is_weekend = F.col("weekday") >= 5
    means = daily.where(F.col("station").isNotNull()).groupBy("station").agg(
        F.avg(F.when(~is_weekend, total)).alias("weekday_mean"),
        F.avg(F.when(is_weekend, total)).alias("weekend_mean"),
    )
    change = ratio_or_null(F.col("weekend_mean"), F.col("weekday_mean")) - 1
    return means.withColumn("change", change).withColumns({
        "direction": balance_label(F.col("change")),
        "change_text": signed_percent(F.col("change")),
    })


def cluster_hours(long: DataFrame, labels: DataFrame) -> DataFrame:
    """Boardings by cluster name and hour, 24 rows per cluster.

    Taps are summed by station before they meet the labels, so the join moves
    station × hour rows and not the facts.
    """
    boarded = in_day(long.where(F.col("direction") == "board"), ["station"])
    by_station = boarded.groupBy("station", "hour").agg(F.sum("count").alias("slot"))
    named = labels.select("station", "cluster_name").join(by_station, "station", "left")
    profile = (
        named.groupBy("cluster_name", "hour").agg(F.sum("slot").alias("slot"))
        .groupBy("cluster_name").agg(*slot_sums("slot"))
    )
    return dense_hours(profile, ["cluster_name"], "boardings")


def cluster_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("cluster_name").agg(F.count("*").alias("n_stations"))


def hourly_cv(long: DataFrame) -> DataFrame:
    """Coefficient of variation of the 24 dense hour sums by station."""
    hourly = in_day(long, ["station"]).groupBy("station", "hour").agg(F.sum("count").alias("slot"))
    spread = hourly.groupBy("station").agg(*spread_parts("slot"))
    return spread.select("station", dense_cv().alias("cv_hourly"))


def spread_parts(value: str) -> list[Column]:
    """Aggregates that ``dense_cv`` needs, over the hours that occur."""
    return [
        F.count(value).alias("n_hours"), F.avg(value).alias("mean_present"),
        F.var_pop(value).alias("variance_present"),
    ]


def dense_cv() -> Column:
    """Population deviation over mean of a 24-hour day, 0 when the mean is 0.

    Hours that do not occur count as 0: the squared deviations of the present ones are
    joined with those of 24 − n zeros.
    """
    n, mean = F.col("n_hours"), F.col("mean_present")
    squares = n * F.col("variance_present") + n * (24 - n) / 24 * mean * mean
    return ratio_or_zero(F.sqrt(squares / 24), n * mean / 24)
