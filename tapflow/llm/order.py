"""Places and running totals in a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.llm.store import written

_WITHIN = (1 << 33) - 1


def in_global_order(df: DataFrame, order: list, name: str, value: str | None = None) -> DataFrame:
    """Add ``name``: how many rows (or how much of ``value``) come before each row.

    Rows are range-sorted and written once with their place; each range then needs one
    offset, a window over one row per range. A running total inside a range is a window
    over that range alone, which the sort keeps even however hot a key is.
    """
    placed = written(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part, within = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit(_WITHIN))
    amount = F.lit(1) if value is None else F.col(value)
    totals = placed.groupBy(part.alias("_part")).agg(F.sum(amount).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    placed = placed.withColumn("_part", part)
    if value is None:
        before = within
    else:
        ahead = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_ahead", F.coalesce(F.sum(amount).over(ahead), F.lit(0)))
        before = F.col("_ahead")
    # one offset per range: as many rows as the sort had tasks
    placed = placed.join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, (F.col("_offset") + before).cast("long")).drop("_place", "_part", "_offset", "_ahead")
