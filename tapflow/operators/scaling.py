"""Standard and min–max scaling with statistics taken from a table.

The statistics are a one-row scalar subquery, so a fitted scaler is a column
expression that can be applied to any frame with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


STATISTICS = "_statistics"


@dataclass(frozen=True)
class StandardScaler:
    """Mean 0 and population deviation 1; a constant column keeps scale 1."""

    columns: list[str]
    statistics: Column

    def _apply(self, df: DataFrame, formula: Callable[[Column, Column, Column], Column]) -> DataFrame:
        # Bound to a column once, so that the subquery is planned once and not per field.
        return df.withColumn(STATISTICS, self.statistics).withColumns({
            name: formula(F.col(name), F.col(f"{STATISTICS}.mean_{name}"), F.col(f"{STATISTICS}.std_{name}"))
            for name in self.columns
        }).drop(STATISTICS)

    def transform(self, df: DataFrame) -> DataFrame:
        return self._apply(df, lambda value, mean, std: (value - mean) / std)

    def inverse(self, df: DataFrame) -> DataFrame:
        return self._apply(df, lambda value, mean, std: value * std + mean)


def fit_standard(df: DataFrame, columns: list[str]) -> StandardScaler:
    parts = []
    for name in columns:
        std = F.stddev_pop(name)
        parts.append(F.avg(name).alias(f"mean_{name}"))
        parts.append(F.when(std > 0, std).otherwise(1.0).alias(f"std_{name}"))
    row = df.agg(F.struct(*parts).alias("statistics"))
    return StandardScaler(list(columns), row.scalar())


ON_CONSTANT = ("keep", "zero", "eps")


def min_max(df: DataFrame, columns: list[str], on_constant: str = "keep") -> DataFrame:
    """Scale columns to 0..1 over the frame.

    A constant column keeps its value (``keep``) or becomes 0 (``zero``); ``eps`` adds
    1e-9 to every column's range instead.
    """
    if on_constant not in ON_CONSTANT:
        raise ValueError(f"on_constant must be one of {ON_CONSTANT}")
    parts = [
        part for name in columns
        for part in (F.min(name).alias(f"low_{name}"), F.max(name).alias(f"high_{name}"))
    ]
    limits = df.agg(F.struct(*parts).alias("limits")).scalar()

    def scaled(name: str) -> Column:
        value, low, high = F.col(name), F.col(f"{STATISTICS}.low_{name}"), F.col(f"{STATISTICS}.high_{name}")
        if on_constant == "eps":
            return (value - low) / (high - low + F.lit(1e-9))
        constant = value if on_constant == "keep" else F.lit(0.0)
        return F.when(high > low, F.try_divide(value - low, high - low)).otherwise(constant)

    return df.withColumn(STATISTICS, limits).withColumns({name: scaled(name) for name in columns}).drop(STATISTICS)
