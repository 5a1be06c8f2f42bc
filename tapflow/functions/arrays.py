"""Arrays of ordered values inside one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ordered_values(order: Column, value: Column) -> Column:
    """Aggregate: values of a small group as one array in ``order``."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.transform(pairs, lambda pair: pair["v"])


def closed_ring(values: Column) -> Column:
    """The array with its first element appended."""
    return F.array_append(values, F.element_at(values, 1))


def number_text(values: Column, digits: int) -> Column:
    """Comma text of a number array at fixed digits."""
    return F.array_join(
        F.transform(values, lambda v: F.format_string(f"%.{digits}f", F.round(v, digits))), ","
    )
