"""Entity ids, lookups, flags and set operations.

Lookup tables carry no broadcast hint: Spark broadcasts a side it has measured below
its threshold and otherwise sort-merges, splitting hot keys at run time. Each is made
unique by key first (its smallest row counts), so a doubled key adds no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapflow.functions.text import contains_all_words, contains_ignoring_case
from tapflow.operators.running import with_position


def _unique(lookup: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per key: the smallest combination of the columns."""
    smallest = F.min(F.struct(*columns)).alias("_row")
    return lookup.groupBy(key).agg(smallest).select(key, *[F.col(f"_row.{name}").alias(name) for name in columns])


def station_ids(long: DataFrame) -> DataFrame:
    """(station, station_id): dense ids from 1 in name order."""
    names = long.where(F.col("station").isNotNull()).select("station").distinct()
    return with_position(names, ["station"], "station_id")


def assign_station_id(long: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Add ``station_id``, from a kept id table where one is given."""
    known = station_ids(long) if ids is None else _unique(ids, "station", "station_id")
    return long.join(known, "station", "left")


def attach_region(long: DataFrame, places: DataFrame) -> DataFrame:
    """Add lat, lon and gu of the station; NULL where the place is not known."""
    return long.join(_unique(places, "station", "lat", "lon", "gu"), "station", "left")


def with_display_name(df: DataFrame, names: DataFrame, key: str = "station") -> DataFrame:
    """Add ``display_name``: the English name, or the key itself."""
    lookup = _unique(names, key, "en_name").withColumnRenamed("en_name", "_en_name")
    return (
        df.join(lookup, key, "left")
        .withColumn("display_name", F.coalesce("_en_name", key))
        .drop("_en_name")
    )


def keep_entities(df: DataFrame, focus: DataFrame, key: str = "station") -> DataFrame:
    return df.join(focus.select(key), key, "left_semi")


def flag_entities(df: DataFrame, focus: DataFrame, key: str = "station") -> DataFrame:
    """Add ``in_focus``: whether the row's key occurs in ``focus``."""
    marks = focus.select(key).distinct().withColumn("_mark", F.lit(True))
    return (
        df.join(marks, key, "left")
        .withColumn("in_focus", F.col("_mark").isNotNull())
        .drop("_mark")
    )


def check_hypotheses(labels: DataFrame, focus: DataFrame) -> DataFrame:
    """Found against expected archetype: as a whole text, and word by word."""
    both = _unique(focus, "station", "hypothesis").join(labels, "station")
    return both.select(
        "station", "cluster", "cluster_name", "hypothesis",
        contains_ignoring_case(F.col("cluster_name"), F.col("hypothesis")).alias("whole_match"),
        contains_all_words(F.col("cluster_name"), F.col("hypothesis")).alias("word_match"),
    )


def common_entities(left: DataFrame, right: DataFrame, key: str = "station") -> DataFrame:
    return left.select(key).where(F.col(key).isNotNull()).intersect(right.select(key))


def distinct_union(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    return left.select(name).union(right.select(name)).distinct()
