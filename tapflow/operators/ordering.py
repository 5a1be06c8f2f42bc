"""Ranks, first and last values, peaks, top rows and previews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tapflow import fixed


def average_rank(value: str, descending: bool = True) -> Column:
    """Rank with the mean place on ties, for small tables such as the k centroids."""
    order = F.desc(value) if descending else F.asc(value)
    ties = F.count("*").over(Window.partitionBy(value))
    return F.rank().over(Window.orderBy(order)) + (ties - 1) / 2


def dedupe_names(df: DataFrame, name: str, order: str, out: str) -> DataFrame:
    """Suffix repeated names with `` 2``, `` 3`` … in ``order``."""
    turn = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return df.withColumn("_turn", turn).withColumn(
        out, F.when(F.col("_turn") > 1, F.concat_ws(" ", F.col(name), F.col("_turn"))).otherwise(F.col(name))
    ).drop("_turn")


def first_last(series: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """First and last value of each series and its number of points."""
    return series.groupBy(by).agg(
        F.min_by(value, order).alias("first_value"),
        F.max_by(value, order).alias("last_value"),
        F.count("*").alias("n_points"),
    )


def peak_hour(hourly: DataFrame, value: str = "taps") -> DataFrame:
    """Hour of the largest value by station, the earliest on ties."""
    best = F.struct(F.col(value), -F.col("hour"))
    return hourly.groupBy("station").agg(
        F.max_by("hour", best).alias("peak_hour"), F.max(value).alias("peak_value")
    )


def peak_cell(surface: DataFrame) -> DataFrame:
    """Weekday and hour of the largest surface value by station, row-major first on ties."""
    best = F.struct("value", -F.col("weekday"), -F.col("hour"))
    cell = F.struct("weekday", "hour")
    top = surface.groupBy("station").agg(
        F.max_by(cell, best).alias("cell"), F.max("value").alias("peak_value")
    )
    return top.select(
        "station", F.col("cell.weekday").alias("peak_weekday"),
        F.col("cell.hour").alias("peak_hour"), "peak_value",
    )


def top_columns(ranked: DataFrame, n: int = fixed.TOP_COLUMNS) -> DataFrame:
    return ranked.orderBy("rank").limit(n)


def preview(df: DataFrame, keys: list[str | Column], n: int = fixed.PREVIEW_ROWS,
            complete: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """First ``n`` rows as texts, with the table's row and column counts on each.

    ``complete`` may add looked-up columns; it sees the ``n`` rows, not the table.
    """
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    df = complete(df.orderBy(*keys).limit(n))
    cells = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 3)
        cells.append(column.cast("string").alias(field.name))
    return df.orderBy(*keys).select(
        *cells, total.alias("total_rows"), F.lit(len(df.columns)).alias("total_cols")
    )
