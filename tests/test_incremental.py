"""Monthly states: refreshed month by month, equal to a full run, and only changed months read."""

import glob
import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tapflow.operators import aggregates, features, states
from tapflow.plans import incremental
from tapflow.schemas import HOURLY_LONG
from tapflow.sources import versions
from tapflow.sources.tables import write_stage


def taps(spark, months, seed=1, n=400):
    rng = random.Random(seed)
    return spark.createDataFrame([
        (date(2024, m, 1), rng.choice(["L1", None]), rng.choice(["a", "b", "c", None]), rng.choice([*range(24), None]),
         rng.choice(["board", "alight", None]), rng.choice([None, 0, rng.randrange(10_000), 2 ** 40]))
        for m in months for _ in range(n)
    ], HOURLY_LONG)


def put(df, path):
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month").parquet(path)


def rows(df):
    return sorted(map(repr, df.collect()))


def spoiled(folder):
    """Overwrite data files with as many other bytes and the same times: whoever opens one fails."""
    for name in glob.glob(f"{folder}/*"):
        info = os.stat(name)
        with open(name, "wb") as out:
            out.write(b"x" * info.st_size)
        os.utime(name, ns=(info.st_atime_ns, info.st_mtime_ns))
    for name in glob.glob(f"{folder}/.*.crc"):
        os.remove(name)


def test_states_give_what_the_facts_give(spark):
    long = taps(spark, range(1, 7)).unionByName(taps(spark, [3], 9).withColumn("year_month", F.lit(None).cast("date")))
    found = states.monthly_states(long)
    assert rows(states.hour_totals_of(found)) == rows(aggregates.hour_totals(long))
    assert rows(states.annual_totals_of(found)) == rows(aggregates.annual_totals(long))
    means = states.hour_direction_mean_of(found)
    assert rows(means.select("station", "hour", "direction", "mean_count")) == rows(aggregates.hour_direction_mean(long))
    exact = long.dropna(subset=states.STATE_KEYS).groupBy(*states.STATE_KEYS).agg(F.stddev_pop("count").alias("std"))
    for row in means.join(exact, states.STATE_KEYS).collect():
        assert row.std is None or row.std_count == pytest.approx(row.std, rel=1e-9, abs=1e-6)
    as_long = states.states_as_long(found)
    digits = [F.round(c, 9).alias(c) for c in features.station_features(long).columns if c != "station"]
    assert rows(features.station_features(as_long).select("station", *digits)) == rows(features.station_features(long).select("station", *digits))
    parts = states.merged_states(found.where("month(year_month) < 3").unionByName(found.where("month(year_month) >= 3 OR year_month IS NULL")), *states.STATE_KEYS)
    assert rows(parts) == rows(states.merged_states(found, *states.STATE_KEYS))


def test_a_changed_month_is_read_alone(spark, tmp_path):
    path, folder = str(tmp_path / "long"), str(tmp_path / "state")
    write_stage(taps(spark, range(1, 6)), path, partition_by=["year_month"])
    first = incremental.refresh(spark, path, folder)
    assert sorted(first.counted) == [date(2024, m, 1) for m in range(1, 6)] and first.ledger == 1
    assert incremental.refresh(spark, path, folder) == incremental.Refreshed([], [], 1)

    put(taps(spark, [4, 6], seed=2), path)
    full = states.monthly_states(spark.read.schema(HOURLY_LONG).parquet(path)).select("year_month", *states.STATE_KEYS, "n", "total", "squares")
    expected = rows(full)
    for month in (1, 2, 3, 5):
        spoiled(f"{path}/year_month=2024-0{month}-01")
    with pytest.raises(Exception):
        spark.read.schema(HOURLY_LONG).parquet(path).agg(F.sum("count")).collect()
    second = incremental.refresh(spark, path, folder)
    assert sorted(second.counted) == [date(2024, 4, 1), date(2024, 6, 1)] and second.gone == []
    assert rows(incremental.current_states(spark, folder)) == expected
    plan = incremental.changed_rows(spark, path, second.counted)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year_month" in plan


def test_months_that_go_or_empty_are_not_counted(spark, tmp_path):
    path, folder = str(tmp_path / "long"), str(tmp_path / "state")
    both = taps(spark, [1, 2]).unionByName(taps(spark, [3], 4, 5).withColumn("year_month", F.lit(None).cast("date")))
    put(both, path)
    incremental.refresh(spark, path, folder)
    assert incremental.current_states(spark, folder).where("year_month IS NULL").count() > 0
    for name in os.listdir(f"{path}/year_month=2024-02-01"):
        os.remove(f"{path}/year_month=2024-02-01/{name}")
    taps(spark, [1]).limit(0).drop("year_month").coalesce(1).write.mode("overwrite").parquet(f"{path}/year_month=2024-01-01")
    changed = incremental.refresh(spark, path, folder)
    assert changed.gone == [date(2024, 2, 1)] and changed.counted == [date(2024, 1, 1)]
    assert [r.year_month for r in incremental.current_states(spark, folder).select("year_month").distinct().collect()] == [None]
    before = rows(incremental.current_states(spark, folder))
    assert incremental.drop_superseded(spark, folder) == 2
    assert rows(incremental.current_states(spark, folder)) == before


def test_a_refresh_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "long"), str(tmp_path / "state")
    put(taps(spark, [1, 2]), path)
    incremental.refresh(spark, path, folder)
    before = rows(incremental.current_states(spark, folder))
    put(taps(spark, [2], seed=7), path)

    def broken(df, place, number):
        df.write.parquet(versions.path_of(place, number))
        os.remove(f"{versions.path_of(place, number)}/_SUCCESS")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(incremental, "write_version", broken)
        incremental.refresh(spark, path, folder)
    assert rows(incremental.current_states(spark, folder)) == before
    assert incremental.refresh(spark, path, folder).ledger == 2
    assert rows(incremental.current_states(spark, folder)) != before


def test_without_a_ledger_there_are_no_states(spark, tmp_path):
    assert incremental.current_states(spark, str(tmp_path / "none")).count() == 0
    assert versions.latest(spark, str(tmp_path / "none")) == 0


