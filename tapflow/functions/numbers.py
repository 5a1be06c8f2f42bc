"""Lenient and strict numbers, guarded ratios and scales."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapflow import fixed


def lenient_double(value: Column) -> Column:
    """Number of a text, NULL where it is none."""
    text = F.trim(value.cast("string"))
    # A trailing type letter is a Java spelling, not a number.
    number = F.when(~F.lower(F.right(text, F.lit(1))).isin("d", "f"), text).try_cast("double")
    return F.when(~F.isnan(number), number)


def lenient_count(value: Column) -> Column:
    """Whole number of a text, fractions cut off, 0 where there is none."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("bigint"), lenient_double(value).try_cast("bigint"), F.lit(0))


def amount_krw(text: Column) -> Column:
    """KRW of a comma text in units of 10,000; any other text fails the job."""
    units = F.trim(F.replace(text, F.lit(","))).try_cast("bigint")
    complaint = F.concat(F.lit("not an amount: "), F.coalesce(text, F.lit("NULL")))
    return F.coalesce(units, F.raise_error(complaint).cast("bigint")) * F.lit(fixed.AMOUNT_UNIT)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where the denominator is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole.cast("double")))


def ratio_or_null(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL where the denominator is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_change(first: Column, last: Column) -> Column:
    return (ratio_or_null(last, first) - 1) * 100


def settled_round(value: Column, digits: int) -> Column:
    """Round at ``digits`` after dropping the last bits, which depend on the order in which
    tasks add up; so a tie falls the same way in every run."""
    return F.round(F.round(value, digits + 8), digits)


def thousands(value: Column) -> Column:
    return value / F.lit(1e3)


def millions(value: Column) -> Column:
    return value / F.lit(1e6)
