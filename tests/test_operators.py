"""Features, surfaces, ids and statistics on hand-made rows."""

import datetime
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow import dims, fixed
from tapflow.operators import aggregates, distributions, lookup, ordering, reshape
from tapflow.operators.features import complete_features, station_features
from tapflow.operators.running import with_position
from tapflow.plans import chart_tables as charts

LONG = "station string, hour int, direction string, count long"
FULL = "year_month date, line string, " + LONG
JAN = datetime.date(2024, 1, 1)


def reference_features(cells):
    """Brute force of the six features from {(hour, direction): count}."""
    hours = np.zeros(24)
    for (hour, _), count in cells.items():
        hours[hour] += count
    total, morning = hours.sum(), hours[[7, 8, 9]].sum()
    boarded = sum(c for (h, d), c in cells.items() if h in (7, 8, 9) and d == "board")
    alighted = sum(c for (h, d), c in cells.items() if h in (7, 8, 9) and d == "alight")
    return [
        hours[7:10].max() / total if total else 0.0,
        hours[17:20].max() / total if total else 0.0,
        (hours[17:].sum() + hours[:2].sum()) / morning if morning else None,
        hours[[22, 23, 0, 1]].sum() / total if total else 0.0,
        (alighted - boarded) / (alighted + boarded) if alighted + boarded else 0.0,
        hours.std() / hours.mean() if hours.mean() else 0.0,
    ]


def test_station_features_against_brute_force(spark):
    rng = random.Random(1)
    cases = {
        "full": {(h, d): rng.randint(0, 50) for h in range(24) for d in ("board", "alight")},
        "gap": {(h, "board"): h + 1 for h in range(24) if h != 8},
        "night": {(23, "board"): 4, (0, "alight"): 2},
        "silent": {(5, "board"): 0, (8, "board"): 0},
        "one": {(8, "alight"): 7},
    }
    rows = [(s, h, d, c) for s, cells in cases.items() for (h, d), c in cells.items()]
    rows += [(None, 3, "board", 9), ("one", 24, "board", 99), ("one", None, "board", 99)]
    found = station_features(spark.createDataFrame(rows, LONG))
    assert [row.station for row in found.collect()] == sorted(cases)
    for row in found.collect():
        for got, wanted in zip(row[1:], reference_features(cases[row.station])):
            assert got == wanted if wanted is None else math.isclose(got, wanted, abs_tol=1e-12)
    complete, rejects = complete_features(found)
    assert {row.station for row in rejects.collect()} == {"night", "silent"}
    assert complete.count() == 3


def test_features_carry_id(spark):
    rows = [("b", 8, "board", 1), ("a", 8, "board", 1)]
    long = lookup.assign_station_id(spark.createDataFrame(rows, LONG))
    found = station_features(long).select("station", "station_id").orderBy("station").collect()
    assert [tuple(row) for row in found] == [("a", 1), ("b", 2)]


def test_positions_are_dense_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    numbered = with_position(df.repartition(16), ["name"], "place").collect()
    ordered = sorted(row.name for row in numbered)
    assert {row.name: row.place for row in numbered} == {name: i + 1 for i, name in enumerate(ordered)}


def test_kept_ids_and_unknown_names(spark):
    ids = spark.createDataFrame([("a", 7)], "station string, station_id long")
    long = spark.createDataFrame([("a", 8, "board", 1), ("z", 8, "board", 1)], LONG)
    found = {row.station: row.station_id for row in lookup.assign_station_id(long, ids).collect()}
    assert found == {"a": 7, "z": None}


DAILY = "date date, weekday int, line string, station string, board_total long, alight_total long"


def test_surface(spark):
    long = spark.createDataFrame([
        ("a", 8, "board", 3), ("a", 9, "board", 1), ("b", 8, "board", 0), ("c", 8, "board", 1),
    ], LONG)
    daily = spark.createDataFrame([
        (JAN, 0, "1", "a", 10, 10), (JAN, 0, "2", "a", 4, 0), (JAN, 1, "1", "b", 5, 5), (JAN, 1, "1", "d", 5, 5),
    ], DAILY)
    cells = {(r.station, r.weekday, r.hour): r.value
             for r in aggregates.weekday_hour_surface(long, daily).collect()}
    assert len(cells) == 168 and {key[0] for key in cells} == {"a"}
    assert cells[("a", 0, 8)] == 12 * 0.75 and cells[("a", 0, 9)] == 12 * 0.25
    assert cells[("a", 1, 8)] == 0.0
    listed = aggregates.weekday_hour_surface(long, daily, ["a", "b", "c"]).collect()
    assert {r.station for r in listed} == {"a", "c"}
    assert {r.value for r in listed if r.station == "c"} == {0.0}
    wide = reshape.weekday_hour_wide(aggregates.weekday_hour_surface(long, daily)).collect()
    assert len(wide) == 7 and wide[0].__fields__[3:] == [f"{h:02d}" for h in range(24)]
    peak = ordering.peak_cell(aggregates.weekday_hour_surface(long, daily)).first()
    assert (peak.peak_weekday, peak.peak_hour, peak.peak_value) == (0, 8, 9.0)


def test_means_are_over_rows_of_lines(spark):
    long = spark.createDataFrame([
        (JAN, "1", "a", 8, "board", 10), (JAN, "2", "a", 8, "board", 20), (JAN, "1", "b", 8, "board", 15),
    ], FULL)
    means = {row.station: row.mean_count for row in aggregates.hour_direction_mean(long).collect()}
    assert means == {"a": 15.0, "b": 15.0}
    ranked = aggregates.column_distinctiveness(long).collect()
    assert [(r.column_label, r.cv, r["rank"], r.distinctive) for r in ranked] == [("08:00 board", 0.0, 1, True)]


def test_column_rank_ties_and_top_flag(spark):
    rows = [(s, h, d, 5 if h < 3 else h * (1 + (s == "b"))) for s in "ab" for h in range(10)
            for d in ("board", "alight")]
    ranked = aggregates.column_distinctiveness(spark.createDataFrame(rows, LONG)).orderBy("rank").collect()
    assert len(ranked) == 20 and sum(r.distinctive for r in ranked) == 8
    keys = [(-r.cv, r.hour, r.direction) for r in ranked]
    assert keys == sorted(keys)
    assert ordering.top_columns(aggregates.column_distinctiveness(spark.createDataFrame(rows, LONG))).count() == 16


def test_peak_hour_takes_the_first(spark):
    df = spark.createDataFrame([("a", 5, 9), ("a", 3, 9), ("a", 4, 1)], "station string, hour int, taps long")
    row = ordering.peak_hour(df).first()
    assert (row.peak_hour, row.peak_value) == (3, 9)


def test_average_rank_on_ties(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (3.0,), (2.0,)], "x double")
    ranks = df.select("x", ordering.average_rank("x").alias("r")).collect()
    assert sorted((row.x, row.r) for row in ranks) == [(1.0, 4.0), (2.0, 3.0), (3.0, 1.5), (3.0, 1.5)]


def test_preview(spark):
    df = spark.createDataFrame([(i, datetime.date(2024, 1, i), i / 3) for i in range(1, 31)],
                               "i int, d date, x double")
    rows = ordering.preview(df, ["i"], 2).collect()
    assert [tuple(row) for row in rows] == [("1", "2024-01-01", "0.333", 30, 3), ("2", "2024-01-02", "0.667", 30, 3)]


def ks_by_hand(a, b):
    best = (-1, None)
    for x in sorted(set(a) | set(b)):
        gap = abs(sum(v <= x for v in a) - sum(v <= x for v in b))
        if gap > best[0]:
            best = (gap, x)
    return best


def exact_p(gap, n):
    if gap == 0:
        return 1.0
    return min(1.0, 2 * sum((-1) ** (j - 1) * math.comb(2 * n, n - j * gap) for j in range(1, n // gap + 1))
               / math.comb(2 * n, n))


def test_ks(spark):
    rng = random.Random(3)
    samples = {s: [round(rng.random() * (1 + i), 1) for _ in range(24)] for i, s in enumerate("abc")}
    df = spark.createDataFrame(list(samples.items()), "station string, shares array<double>")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "a")], "station_a string, station_b string")
    for row in distributions.ks_p_values(distributions.ks_two_sample(df, pairs)).collect():
        gap, x = ks_by_hand(samples[row.station_a], samples[row.station_b])
        assert row.ks == pytest.approx(gap / 24) and row.at_share == x
        assert abs(row.cdf_a - row.cdf_b) == pytest.approx(gap / 24)
        assert row.p_exact == pytest.approx(exact_p(gap, 24), abs=1e-12)
        assert 0.0 <= row.p_limit <= 1.0


def test_ecdf_steps(spark):
    df = spark.createDataFrame([("a", [0.5, 0.1, 0.1, 0.3])], "station string, shares array<double>")
    rows = distributions.ecdf(df).orderBy("step").collect()
    assert [(r.step, r.share, r.cumulative) for r in rows] == [
        (1, 0.1, 0.25), (2, 0.1, 0.5), (3, 0.3, 0.75), (4, 0.5, 1.0),
    ]


def test_focus_filter_reaches_the_scan(spark, sf_dir):
    from workload import inputs
    table = charts.chart_b(inputs.taps_by_type(spark, sf_dir), inputs.FOCUS)
    plan = table._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert re.search(r"DataFilters: .*event_type#\d+ IN \(click,view,purchase\)", scan)


def test_annual_totals_show_every_year(spark):
    rows = [(datetime.date(2024 + i, 6, 1), "1", "강남", 8, "board", 1_000_000 * (i + 1)) for i in range(3)]
    focus = dims.default_focus()
    table = charts.chart_c(spark.createDataFrame(rows, FULL), focus).orderBy("year").collect()
    assert [(r.display_name, r.year, r.taps_millions) for r in table] == [
        ("Gangnam", 2024, 1.0), ("Gangnam", 2025, 2.0), ("Gangnam", 2026, 3.0),
    ]


def test_chart_g_fills_silent_stations(spark):
    long = spark.createDataFrame([("강남", 8, "board", 2000)], LONG)
    rows = {r.station: (r.alight_thousands, r.board_thousands) for r in charts.chart_g(long, dims.default_focus()).collect()}
    assert rows == {"강남": (0.0, 2.0), "홍대입구": (0.0, 0.0), "여의도": (0.0, 0.0)}


def test_hypotheses(spark):
    labels = spark.createDataFrame([
        ("강남", 0, "Business District 2"), ("홍대입구", 1, "District of Nightlife"), ("여의도", 2, "Mixed"),
    ], "station string, cluster int, cluster_name string")
    found = {r.station: (r.whole_match, r.word_match)
             for r in lookup.check_hypotheses(labels, dims.focus_dimension(spark)).collect()}
    assert found == {"강남": (True, True), "홍대입구": (False, True), "여의도": (False, False)}


def test_lookup_misses(spark):
    places = spark.createDataFrame([("a", 1.0, 2.0, "g")], "station string, lat double, lon double, gu string")
    long = spark.createDataFrame([("a", 8, "board", 1), ("b", 8, "board", 1)], LONG)
    found = {r.station: (r.lat, r.gu) for r in lookup.attach_region(long, places).collect()}
    assert found == {"a": (1.0, "g"), "b": (None, None)}


def test_month_spine_and_day_mix(spark):
    one = spark.range(1).select(F.lit("202401").alias("end"))
    spine = [r.month for r in dims.month_spine(one, F.col("end"), 3).orderBy("month").collect()]
    assert spine == ["202311", "202312", "202401"]
    mixed = dims.with_day_mix(spark.range(1).select(F.lit(datetime.date(2024, 2, 9)).alias("m")), F.col("m")).first()
    assert (mixed.n_days, mixed.n_weekdays, mixed.n_weekend_days) == (29, 21, 8)


def test_feature_plan_combines_before_each_exchange(spark, sf_dir):
    from workload import inputs
    plan = inputs.features_by_user(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type" not in plan
    assert len(fixed.FEATURES) == 6
