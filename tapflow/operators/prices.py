"""Monthly price index: an exact median that splits hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.functions.dates import month_start
from tapflow.functions.numbers import millions, percent_change
from tapflow.operators.ordering import first_last
from tapflow.staging import written

# Buckets per doubling of the value.
SCALE = 16 * 1024


def _bucket(value: Column) -> Column:
    """Number that never falls as the value rises; equal for values 4e-5 apart or less."""
    size = F.floor(F.least(F.log2(F.abs(value)), F.lit(1100.0)) * SCALE) + 1100 * SCALE
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0).cast("bigint")


def exact_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Median of ``value`` by ``keys``, the mean of the two middle values on even counts.

    Keys and values are written once; the rows are then read twice and never sorted or
    shuffled as a whole. The first pass counts narrow buckets of each group, combined before
    their exchange however large a group is, and writes the one or two buckets that hold its
    middle ranks. The second keeps only the rows inside these (Spark broadcasts the written
    table where its size allows), counts their equal values and orders the distinct ones.
    Null keys, null and NaN values are left out.
    """
    facts = written(df.select(*keys, F.col(value).cast("double").alias(value)), "values")
    usable = ~F.isnan(value) & F.col(value).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    rows = facts.where(usable).withColumn("bucket", _bucket(F.col(value)))
    groups = [*keys, "bucket"]
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum("held").over(Window.partitionBy(*keys))
    middle = (
        rows.groupBy(*groups).agg(F.count("*").alias("held"))
        .select(
            *groups, "held", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("below"),
            F.floor((size + 1) / 2).alias("low_rank"), (F.floor(size / 2) + 1).alias("high_rank"),
        )
        .where("below < high_rank AND below + held >= low_rank")
        .drop("held")
    )
    inside = rows.join(written(middle, "middle"), groups)
    counted = inside.groupBy(*groups, "below", "low_rank", "high_rank", value).agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("last_rank", F.col("below") + F.sum("n").over(upto))
    first_rank = F.col("last_rank") - F.col("n")

    def holding(rank: str) -> Column:
        holds = (first_rank < F.col(rank)) & (F.col("last_rank") >= F.col(rank))
        return F.max(F.when(holds, F.col(value)))

    return ranked.groupBy(*keys).agg(((holding("low_rank") + holding("high_rank")) / 2).alias(name))


def monthly_price_index(trades: DataFrame) -> DataFrame:
    """Median price per square metre by region and contract month."""
    dated = trades.withColumn("year_month", month_start(F.col("contract_date")))
    return exact_median(dated, ["gu_code", "year_month"], "price_per_m2", "median_price_per_m2")


def with_change(index: DataFrame) -> DataFrame:
    """Add each region's percent change from its first to its last month, NULL for one month.

    A region's series has one row per month.
    """
    whole = Window.partitionBy("gu_code").orderBy("year_month").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    first = F.first_value("median_price_per_m2").over(whole)
    last = F.last_value("median_price_per_m2").over(whole)
    several = F.count("*").over(Window.partitionBy("gu_code")) >= 2
    return index.withColumn("change_pct", F.when(several, percent_change(first, last)))


def price_changes(index: DataFrame) -> DataFrame:
    """Start, end (millions) and percent change of each region's series."""
    ends = first_last(index, "gu_code", "year_month", "median_price_per_m2")
    return ends.select(
        "gu_code",
        millions(F.col("first_value")).alias("start_price"),
        millions(F.col("last_value")).alias("end_price"),
        F.when(F.col("n_points") >= 2, percent_change(F.col("first_value"), F.col("last_value")))
        .alias("change_pct"),
        "n_points",
    )
