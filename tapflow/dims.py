"""Calendar spines and fixed dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapflow import fixed
from tapflow.functions.dates import month_date


def constant_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A literal table; its size is that of the given list, so it may be broadcast."""
    records = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)])
        for row in rows
    ]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*records))))


def month_spine(df: DataFrame, end_month: Column, n_months: int) -> DataFrame:
    """One ``month`` row (``yyyyMM``) for each of the last ``n_months`` up to ``end_month``."""
    end = month_date(end_month)
    first = F.add_months(end, -(n_months - 1))
    starts = df.select(F.explode(F.sequence(first, end, F.expr("interval 1 month"))).alias("start"))
    return starts.select(F.date_format("start", "yyyyMM").alias("month"))


def with_day_mix(df: DataFrame, month: Column) -> DataFrame:
    """Add ``n_days``, ``n_weekdays`` and ``n_weekend_days`` of the month a date lies in."""
    days = F.sequence(F.trunc(month, "MM"), F.last_day(month))
    weekend = F.size(F.filter(days, lambda day: F.weekday(day) >= 5))
    return df.withColumns({
        "n_days": F.size(days),
        "n_weekdays": F.size(days) - weekend,
        "n_weekend_days": weekend,
    })


def region_dimension(spark: SparkSession) -> DataFrame:
    """Regions with code, focus flag and English name (focus only)."""
    rows = [
        (number, name, code, fixed.FOCUS_REGIONS.get(name), name in fixed.FOCUS_REGIONS)
        for number, (name, code) in enumerate(fixed.REGIONS)
    ]
    return constant_table(spark, ["region_no", "gu", "gu_code", "gu_en", "in_focus"], rows)


def focus_dimension(spark: SparkSession) -> DataFrame:
    """Stations in focus with names, region and expected archetype."""
    rows = [
        (order, name, full, short, gu, fixed.FOCUS_REGIONS[gu], hypothesis)
        for order, (name, full, short, gu, hypothesis) in enumerate(fixed.FOCUS_STATIONS)
    ]
    return constant_table(
        spark, ["display_order", "station", "full_name", "en_name", "gu", "gu_en", "hypothesis"], rows
    )


@dataclass(frozen=True)
class Focus:
    """The few stations a chart shows, in display order: name → English name.

    Being a short list, it filters by membership, which Parquet scans can use.
    """

    names: dict[str, str]

    def keep(self, df: DataFrame, key: str = "station") -> DataFrame:
        return df.where(F.col(key).isin(list(self.names)))

    def holds(self, key: str = "station") -> Column:
        return F.col(key).isin(list(self.names))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(order, name, english) for order, (name, english) in enumerate(self.names.items())]
        return constant_table(spark, ["display_order", "station", "en_name"], rows)


def default_focus() -> Focus:
    return Focus({name: short for name, _, short, _, _ in fixed.FOCUS_STATIONS})


def hour_spine(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.range(24).select(F.col("id").cast("int").alias("hour")))


def weekday_spine(spark: SparkSession) -> DataFrame:
    names = F.array(*[F.lit(name) for name in fixed.WEEKDAYS])
    return F.broadcast(
        spark.range(7).select(
            F.col("id").cast("int").alias("weekday"),
            F.element_at(names, F.col("id").cast("int") + 1).alias("weekday_name"),
        )
    )


def week_grid(spark: SparkSession) -> DataFrame:
    """The 168 (weekday, hour) cells of a week."""
    cell = F.col("id").cast("int")
    return F.broadcast(
        spark.range(7 * 24).select(
            F.floor(cell / 24).cast("int").alias("weekday"), (cell % 24).alias("hour")
        )
    )
