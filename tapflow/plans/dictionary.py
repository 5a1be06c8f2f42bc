"""Entity ids that never move: a dictionary that only grows.

Each load writes the names it brings as one numbered version; the dictionary is all whole
versions together. New names get the ids after the largest so far, in name order, without
gaps, so a table that carries ids stays right when more names come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.operators.running import with_position
from tapflow.sources.versions import latest, path_of, write_version
from tapflow.staging import written

IDS = "station string, station_id long, load long"


def stored_ids(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """station, station_id and the load that brought it, of all loads or up to a stated one."""
    last = latest(spark, folder) if upto is None else upto
    if not last:
        return spark.createDataFrame([], IDS)
    return spark.read.schema(IDS).parquet(*[path_of(folder, number) for number in range(1, last + 1)])


def extend_ids(long: DataFrame, folder: str) -> int:
    """Add the stations of a long table that the dictionary lacks; returns its newest load.

    Known stations are left out by an anti join, so a repeated or overlapping load changes
    nothing; without new names no version is written. Two writers can't take the same ids:
    the second to finish fails and runs again on what the first has written. Missing names
    get no id.
    """
    spark = long.sparkSession
    last = latest(spark, folder)
    known = stored_ids(spark, folder, last)
    names = long.where(F.col("station").isNotNull()).select("station").distinct()
    new = written(with_position(names.join(known, "station", "left_anti"), ["station"], "place"), "new_ids")
    if not new.take(1):
        return last
    highest = known.agg(F.coalesce(F.max("station_id"), F.lit(0))).first()[0]
    ids = new.select("station", (F.col("place") + highest).cast("long").alias("station_id"), F.lit(last + 1).cast("long").alias("load"))
    return write_version(ids, folder, last + 1)
