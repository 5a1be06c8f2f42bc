"""Incremental stage tables: only months whose files changed are counted again.

Beside the long table lies a table of monthly states, a folder per month and version of its
files, and a ledger of which version of each month is current. A refresh lists the files of
the long table (without opening them), counts the months whose version is new and writes the
next ledger. Readers follow the ledger, so they see all of a refresh or nothing of it, and a
refresh that broke off is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapflow.operators.states import STATE, STATE_KEYS, monthly_states
from tapflow.schemas import HOURLY_LONG
from tapflow.sources.tables import read_stage
from tapflow.sources.versions import latest, read_version, write_version

LEDGER = "year_month date, version string"


@dataclass(frozen=True)
class Refreshed:
    """Months counted by a refresh, months no longer there, and the ledger's number."""

    counted: list[date | None]
    gone: list[date | None]
    ledger: int


def month_versions(spark: SparkSession, path: str) -> DataFrame:
    """year_month and a print of the names, sizes and times of its files. Nothing is opened:
    the binary source's content column is not asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    each = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    # the count keeps sums of different numbers of files apart
    version = F.concat_ws("-", F.count("*").cast("string"), F.lower(F.hex(F.xxhash64(F.sum(each)))))
    return files.groupBy(F.col("year_month").cast("date").alias("year_month")).agg(version.alias("version"))


def _in(months: list[date | None]) -> Column:
    """Membership of a month, which may be missing."""
    known = [month for month in months if month is not None]
    found = F.col("year_month").isin(known) if known else F.lit(False)
    return found | F.col("year_month").isNull() if None in months else found


def refresh(spark: SparkSession, long_path: str, folder: str) -> Refreshed:
    """Bring the states under ``folder`` up to the long table (partitioned by year_month).

    Reads the rows of new and changed months only; a month of any number of rows or stations
    is counted in one combined aggregation.
    """
    ledger = latest(spark, f"{folder}/ledger")
    now = month_versions(spark, long_path)
    known = read_version(spark, f"{folder}/ledger", LEDGER, ledger).withColumnRenamed("version", "known")
    # one row per month of the calendar
    both = now.join(known, now.year_month.eqNullSafe(known.year_month), "full").select(
        F.coalesce(now.year_month, known.year_month).alias("year_month"), "version", "known"
    ).where(~F.col("version").eqNullSafe(F.col("known"))).collect()
    counted = [row["year_month"] for row in both if row["version"] is not None]
    gone = [row["year_month"] for row in both if row["version"] is None]
    if not both:
        return Refreshed([], [], ledger)
    if counted:
        states = monthly_states(changed_rows(spark, long_path, counted))
        named = states.join(F.broadcast(_ledger(spark, both)), states.year_month.eqNullSafe(F.col("month"))).drop("month")
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month", "version").parquet(f"{folder}/states")
    kept = read_version(spark, f"{folder}/ledger", LEDGER, ledger).where(~F.coalesce(_in(counted + gone), F.lit(False)))
    added = _ledger(spark, both).select(F.col("month").alias("year_month"), "version").where(_in(counted))
    return Refreshed(counted, gone, write_version(kept.unionByName(added).coalesce(1), f"{folder}/ledger", ledger + 1))


def _ledger(spark: SparkSession, both: list) -> DataFrame:
    rows = [(row["year_month"], row["version"]) for row in both if row["version"] is not None]
    return spark.createDataFrame(rows, "month date, version string")


def changed_rows(spark: SparkSession, long_path: str, months: list[date | None]) -> DataFrame:
    """Rows of the stated months; the filter is on the partition column, so other folders stay shut."""
    return read_stage(spark, long_path, HOURLY_LONG).where(_in(months))


def current_states(spark: SparkSession, folder: str) -> DataFrame:
    """States of all months by the newest ledger: year_month, station, hour, direction, n, total, squares.

    Versions superseded since are passed over by their folder.
    """
    ledger = read_version(spark, f"{folder}/ledger", LEDGER)
    if not ledger.take(1):
        return spark.createDataFrame([], f"year_month date, {STATE}")
    states = spark.read.schema(f"{STATE}, year_month date, version string").parquet(f"{folder}/states")
    current = ledger.select(F.col("year_month").alias("month"), F.col("version").alias("current"))
    kept = states.join(
        F.broadcast(current), F.col("year_month").eqNullSafe(F.col("month")) & (F.col("version") == F.col("current")), "left_semi"
    )
    return kept.select("year_month", *STATE_KEYS, "n", "total", "squares")


def drop_superseded(spark: SparkSession, folder: str) -> int:
    """Delete state folders that the newest ledger does not name; returns how many."""
    ledger = {(row["year_month"], row["version"]) for row in read_version(spark, f"{folder}/ledger", LEDGER).collect()}
    names = {f"year_month={month or '__HIVE_DEFAULT_PARTITION__'}/version={version}" for month, version in ledger}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/states/year_month=*/version=*")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [x.getPath() for x in system.globStatus(path) or [] if "/".join(x.getPath().toString().split("/")[-2:]) not in names]
    for place in old:
        system.delete(place, True)
    return len(old)
