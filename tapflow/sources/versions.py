"""Tables kept as numbered versions; a version counts once it is written as a whole."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NUMBER = re.compile(r"/v=(\d+)/_SUCCESS$")


def _system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest(spark: SparkSession, folder: str) -> int:
    """Number of the newest whole version, 0 without one."""
    place, system = _system(spark, f"{folder.rstrip('/')}/v=*/_SUCCESS")
    marks = system.globStatus(place) or []
    return max((int(_NUMBER.search(mark.getPath().toString())[1]) for mark in marks), default=0)


def path_of(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/v={number:08d}"


def read_version(spark: SparkSession, folder: str, schema: str, number: int | None = None) -> DataFrame:
    """The newest version (or a stated one), no rows without one."""
    number = latest(spark, folder) if number is None else number
    if not number:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path_of(folder, number))


def write_version(df: DataFrame, folder: str, number: int) -> int:
    """Write the next version; fails if another writer has taken its number.

    What a broken-off writer left under the number is told by its missing mark and removed.
    """
    spark = df.sparkSession
    place, system = _system(spark, path_of(folder, number))
    if number > latest(spark, folder) and system.exists(place):
        system.delete(place, True)
    df.write.mode("errorifexists").parquet(path_of(folder, number))
    return number
