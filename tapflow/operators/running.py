"""Totals in a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapflow.staging import checkpointed


def with_position(df: DataFrame, order_by: list[str], name: str) -> DataFrame:
    """Number the rows from 1 in the global order of ``order_by``.

    Rows are range-sorted and written once with their partition and place in it. A
    partition's offset is the sum of the earlier partitions' sizes: a window over one
    row per partition, never over the rows. Order keys must be unique for a fixed result.
    """
    place = F.monotonically_increasing_id()
    placed = checkpointed(df.orderBy(*order_by).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        # one offset per partition: its size is fixed by the number of tasks
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_place", "_part", "_offset")
    )


def running_sums(df: DataFrame, by: list[str], order: list[str], sums: list[str]) -> DataFrame:
    """Add ``upto_x`` for each x of ``sums``: its total over the group's rows up to this one.

    Groups are ``by``, order inside them is ``order`` (unique for a fixed result). Rows are
    range-sorted by both, so a group of any size spreads over ranges; a window runs inside
    one group's part of a range, and what lies in earlier ranges is an offset, a window over
    one row per group and range. Rows with a missing group key are left out.
    """
    kept = df.dropna(subset=by) if by else df
    placed = checkpointed(kept.orderBy(*by, *order).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    groups = [*by, "_part"]
    inside = Window.partitionBy(*groups).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*groups).agg(*[F.sum(name).alias(name) for name in sums])
    offsets = totals.select(*groups, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums])
    found = placed.withColumns({f"upto_{name}": F.sum(name).over(inside) for name in sums}).join(offsets, groups)
    return found.withColumns({f"upto_{name}": F.col(f"upto_{name}") + F.col(f"_before_{name}") for name in sums}).drop(
        "_place", "_part", *[f"_before_{name}" for name in sums]
    )


def with_average_rank(df: DataFrame, value: str, name: str, by: list[str] | None = None, descending: bool = True) -> DataFrame:
    """Add the rank of ``value`` with the mean place on ties, for tables of any size.

    Ties are counted before anything is ordered, so a value that a third of all rows share
    is one row; its run then never crosses a range, and the counts before it are running
    sums with an offset per range. Missing and NaN values have no rank.
    """
    by = by or []
    usable = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    counted = df.where(usable).groupBy(*by, value).agg(F.count("*").alias("_n"))
    turned = counted.withColumn("_order", -F.col(value) if descending else F.col(value))
    ranked = running_sums(turned, by, ["_order"], ["_n"])
    ranks = ranked.select(*by, value, (F.col("upto__n") - (F.col("_n") - 1) / 2).alias(name))
    return df.join(ranks, [*by, value], "left")
