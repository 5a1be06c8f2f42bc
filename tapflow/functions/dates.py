"""Dates from raw texts and parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strict_date(text: Column, pattern: str) -> Column:
    """Date of a text; a text that does not fit fails the job, NULL stays NULL."""
    parsed = F.try_to_date(text, pattern)
    complaint = F.concat(F.lit(f"not a {pattern} date: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(complaint).cast("date")).otherwise(parsed)


def month_date(yyyymm: Column) -> Column:
    """First day of a ``yyyyMM`` month."""
    return strict_date(yyyymm, "yyyyMM")


def day_date(yyyymmdd: Column) -> Column:
    return strict_date(yyyymmdd, "yyyyMMdd")


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of three numbers, NULL for an impossible one."""
    midnight = F.lit(0)
    return F.try_make_timestamp_ntz(year, month, day, midnight, midnight, midnight).cast("date")


def weekday(date: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(date)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")
