"""Raw tables to tidy ones, melts, pivots and dense grids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow import fixed
from tapflow.functions.dates import date_of_parts, day_date, month_date, weekday
from tapflow.functions.numbers import amount_krw, lenient_count, lenient_double, ratio_or_null
from tapflow.functions.text import canonical_name


def hour_columns(df: DataFrame) -> list[tuple[str, int, str]]:
    """(column, hour, direction) of each hour column, found by its name."""
    found = []
    for name in df.columns:
        match = re.match(fixed.HOUR_COLUMN_PATTERN, name)
        if match:
            found.append((name, int(match.group(1)), fixed.DIRECTION_OF[match.group(3)]))
    return found


def melt_hours(wide: DataFrame, keep: list[Column]) -> DataFrame:
    """Wide to long: one row per kept identity and hour column.

    Names are parsed once while planning, so rows carry plain literals.
    """
    cells = [
        F.struct(
            F.lit(hour).alias("hour"), F.lit(direction).alias("direction"),
            F.col(f"`{name}`").cast("string").alias("raw_count"),
        )
        for name, hour, direction in hour_columns(wide)
    ]
    # Identities are computed before the rows multiply.
    whole = wide.select(*keep, F.array(*cells).alias("cells"))
    melted = whole.select(*whole.columns[:-1], F.inline("cells"))
    return melted.withColumn("count", lenient_count(F.col("raw_count"))).drop("raw_count")


def hourly_long(wide: DataFrame) -> DataFrame:
    """Tidy hourly table: year_month, line, station, hour, direction, count."""
    return melt_hours(wide, [
        month_date(F.col(fixed.RAW_MONTH)).alias("year_month"),
        F.col(fixed.RAW_LINE).alias("line"),
        canonical_name(F.col(fixed.RAW_STATION)).alias("station"),
    ])


def daily_clean(raw: DataFrame) -> DataFrame:
    """Tidy daily table: date, weekday, line, station, board_total, alight_total."""
    date = day_date(F.col(fixed.RAW_DAY))
    return raw.select(
        date.alias("date"),
        weekday(date).alias("weekday"),
        F.col(fixed.RAW_DAY_LINE).alias("line"),
        canonical_name(F.col(fixed.RAW_DAY_STATION)).alias("station"),
        lenient_count(F.col(fixed.RAW_DAY_BOARD)).alias("board_total"),
        lenient_count(F.col(fixed.RAW_DAY_ALIGHT)).alias("alight_total"),
    )


def trades_clean(raw: DataFrame) -> DataFrame:
    """Tidy sale records with KRW amount and price per square metre."""
    sized = raw.select(
        date_of_parts(
            F.col(fixed.RAW_YEAR), F.col(fixed.RAW_MONTH_NO), F.col(fixed.RAW_DAY_NO)
        ).alias("contract_date"),
        F.col(fixed.RAW_REGION_CODE).alias("gu_code"),
        F.col(fixed.RAW_DONG).alias("dong"),
        F.col(fixed.RAW_COMPLEX).alias("complex"),
        lenient_double(F.col(fixed.RAW_AREA)).alias("area_m2"),
        amount_krw(F.col(fixed.RAW_AMOUNT)).alias("deal_krw"),
        F.col(fixed.RAW_FLOOR).alias("floor"),
        F.col(fixed.RAW_BUILD_YEAR).alias("build_year"),
    )
    return sized.select(
        "contract_date", "gu_code", "dong", "complex", "area_m2", "deal_krw",
        ratio_or_null(F.col("deal_krw"), F.col("area_m2")).alias("price_per_m2"),
        "floor", "build_year",
    )


def direction_pivot(long: DataFrame, by: list[str]) -> DataFrame:
    """Sums by direction as columns ``alight`` and ``board``, missing ones 0."""
    return (
        long.groupBy(*by).pivot("direction", fixed.DIRECTIONS).agg(F.sum("count"))
        .na.fill(0, fixed.DIRECTIONS)
    )


def slot_name(hour: int) -> str:
    return f"h{hour:02d}"


def slot_sums(value: str) -> list[Column]:
    """24 aggregates: the sum of ``value`` at each hour, 0 where there is none."""
    return [
        F.coalesce(F.sum(F.when(F.col("hour") == hour, F.col(value))), F.lit(0)).alias(slot_name(hour))
        for hour in fixed.HOURS
    ]


def in_day(long: DataFrame, by: list[str]) -> DataFrame:
    """Rows with an hour of the day and complete keys."""
    complete = F.col("hour").between(0, 23)
    for name in by:
        complete = complete & F.col(name).isNotNull()
    return long.where(complete)


def hour_profile(long: DataFrame, by: list[str], value: str = "count") -> DataFrame:
    """One row per entity with its 24 dense hour sums ``h00`` .. ``h23``.

    The first grouping combines before the exchange, so an entity with any share of
    the rows sends at most 24 rows per task; the second works on those.
    """
    sums = in_day(long, by).groupBy(*by, "hour").agg(F.sum(value).alias("slot"))
    return sums.groupBy(*by).agg(*slot_sums("slot"))


def slots() -> list[Column]:
    return [F.col(slot_name(hour)) for hour in fixed.HOURS]


def slot_total() -> Column:
    total = F.lit(0).cast("bigint")
    for slot in slots():
        total = total + slot
    return total


def dense_hours(profile: DataFrame, keep: list[str], value: str = "taps") -> DataFrame:
    """Long form of a profile: 24 rows per entity."""
    return profile.select(*keep, F.posexplode(F.array(*slots())).alias("hour", value))


def with_share(rows: DataFrame, by: list[str], value: str, name: str = "share") -> DataFrame:
    """Share of each row in the total of its (small, grouped) entity, NULL when that is 0."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return rows.withColumn(name, ratio_or_null(F.col(value), total))


def weekday_hour_wide(surface: DataFrame) -> DataFrame:
    """Matrix view: one row per station and weekday, columns ``00`` .. ``23``."""
    wide = surface.groupBy("station", "weekday").pivot("hour", fixed.HOURS).agg(F.first("value"))
    names = F.array(*[F.lit(name) for name in fixed.WEEKDAYS])
    return wide.select(
        "station", "weekday", F.element_at(names, F.col("weekday") + 1).alias("weekday_name"),
        *[F.coalesce(F.col(f"`{hour}`"), F.lit(0.0)).alias(f"{hour:02d}") for hour in fixed.HOURS],
    )
