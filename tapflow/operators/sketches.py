"""Sketches of prices and of distinct buildings, stored by region and month and merged over any window.

The approximate counterparts of the exact median and distinct count: a window's figures come
from its sketches, a few kilobytes per region and month, and never from the sales. Both
kinds merge in any order and keep their error bounds; a group of any size is a few
kilobytes in a task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tapflow.functions.dates import month_start

# Items a quantile sketch keeps at its top level; groups of up to as many values are exact.
QUANTILE_K = 2048
# Log2 of a distinct sketch's registers.
DISTINCT_LG = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """Distance in rank, as a share of all values, that a quantile keeps with 99 % confidence."""
    return 2.296 / k ** 0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg / 2)


def price_sketches(trades: DataFrame, k: int = QUANTILE_K, lg: int = DISTINCT_LG) -> DataFrame:
    """gu_code, year_month, n_sales, n_prices, price_sketch, complex_sketch of all sales.

    Sales without a region or a date are left out; missing and NaN prices are counted as
    sales, not as prices; a month without any price has a NULL price sketch.
    """
    price = F.nanvl("price_per_m2", F.lit(None).cast("double"))
    dated = trades.withColumn("year_month", month_start(F.col("contract_date"))).dropna(subset=["gu_code", "year_month"])
    priced = dated.withColumn("price", price)
    found = priced.groupBy("gu_code", "year_month").agg(
        F.count("*").alias("n_sales"), F.count("price").alias("n_prices"),
        F.kll_sketch_agg_double("price", k).alias("price_sketch"), F.hll_sketch_agg("complex", lg).alias("complex_sketch"),
    )
    return found.withColumn("price_sketch", F.when(F.col("n_prices") > 0, F.col("price_sketch")))


def in_window(sketches: DataFrame, first: date, last: date) -> DataFrame:
    """Sketches of the months from ``first`` to ``last``; stored by month, the others stay unread."""
    return sketches.where(F.col("year_month").between(F.lit(first), F.lit(last)))


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of the same keys merged, as if made from their sales together."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_sales").alias("n_sales"), F.sum("n_prices").alias("n_prices"),
        F.kll_merge_agg_double("price_sketch").alias("price_sketch"), F.hll_union_agg("complex_sketch").alias("complex_sketch"),
    )


def approximate_prices(sketches: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Add a column per quantile (median by default) and n_complexes, the distinct buildings.

    A quantile is the smallest value whose rank reaches it, so the median of an even number
    of values is the lower of the middle two. Without prices it is NULL.
    """
    has_prices = F.col("n_prices") > 0
    columns = {
        name: F.when(has_prices, F.kll_sketch_get_quantile_double(F.when(has_prices, F.col("price_sketch")), F.lit(q)))
        for name, q in (quantiles or {"median_price_per_m2": 0.5}).items()
    }
    return sketches.withColumns(columns | {"n_complexes": F.hll_sketch_estimate("complex_sketch")})


def approximate_price_index(trades: DataFrame, k: int = QUANTILE_K) -> DataFrame:
    """As ``prices.monthly_price_index``, by sketches."""
    return approximate_prices(price_sketches(trades, k)).select("gu_code", "year_month", "median_price_per_m2")
