"""Names, labels and display texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def canonical_name(name: Column) -> Column:
    """Name without bracketed parts (Latin or full-width brackets) and without blanks."""
    no_brackets = F.regexp_replace(name, r"(?d)[(（].*?[)）]", "")
    return F.regexp_replace(no_brackets, r"(?U)[\s\x1c-\x1f]+", "")


def column_label(hour: Column, direction: Column) -> Column:
    """Label like ``08:00 board``."""
    return F.format_string("%02d:00 %s", hour, direction)


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def contains_all_words(text: Column, words: Column) -> Column:
    """True when every blank-separated word of ``words`` occurs in ``text``."""
    pieces = F.filter(F.split(F.lower(words), r"\s+"), lambda word: word != "")
    return F.forall(pieces, lambda word: F.contains(F.lower(text), word))


def balance_label(change: Column) -> Column:
    """``weekend-heavy`` for a positive change, else ``weekday-heavy``; NULL when undefined."""
    return F.when(change > 0, "weekend-heavy").when(change.isNotNull(), "weekday-heavy")


def signed_percent(ratio: Column, digits: int = 0) -> Column:
    """Text like ``+12%`` of a ratio."""
    return F.format_string(f"%+.{digits}f%%", ratio * 100)


def hover_text(station: Column, name: Column, morning: Column, late: Column,
               asymmetry: Column, balance: Column) -> Column:
    """One-line description of a station point."""
    return F.format_string(
        "%s (%s) | Morning peak: %.3f | Late-night: %.3f | AM asymmetry: %+.3f | Weekend bal.: %.2f",
        name, station, F.round(morning, 3), F.round(late, 3), F.round(asymmetry, 3), F.round(balance, 2),
    )
