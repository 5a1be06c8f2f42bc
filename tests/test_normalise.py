"""Hand-made rows through cleaning, melting and the price index."""

import datetime
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tapflow import fixed, schemas
from tapflow.functions import dates, numbers, text
from tapflow.operators import prices, reshape
from tapflow.operators.features import station_features
from tapflow.sources import tables


def values(spark, column, kind, items):
    rows = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i int, x {kind}")
    return [row[0] for row in rows.orderBy("i").select(column(F.col("x"))).collect()]


def test_canonical_name(spark):
    names = ["잠실 (송파구청)", "A（B） C", None, "서울역(1호선)", "a　b c\td", "x(y\nz)", "p(q) r(s)", " "]
    assert values(spark, text.canonical_name, "string", names) == [
        "잠실", "AC", None, "서울역", "abcd", "x(yz)", "pr", "",
    ]


def test_lenient_count(spark):
    items = ["x", None, "12.0", " 7 ", "12d", "9007199254740993", "1e3", "3.9", "", "inf", "nan", "-4"]
    assert values(spark, numbers.lenient_count, "string", items) == [
        0, 0, 12, 7, 0, 9007199254740993, 1000, 3, 0, 0, 0, -4,
    ]


def test_amounts(spark):
    assert values(spark, numbers.amount_krw, "string", ["12,500", " 1,234,567 "]) == [125_000_000, 12_345_670_000]
    with pytest.raises(Exception, match="not an amount: abc"):
        values(spark, numbers.amount_krw, "string", ["abc"])


def test_dates(spark):
    assert values(spark, dates.month_date, "string", ["202402", None]) == [datetime.date(2024, 2, 1), None]
    assert values(spark, dates.day_date, "string", ["20240229"]) == [datetime.date(2024, 2, 29)]
    with pytest.raises(Exception, match="not a yyyyMM date: 202413"):
        values(spark, dates.month_date, "string", ["202413"])
    parts = spark.createDataFrame([(2024, 2, 31), (2024, 2, 29), (None, 1, 1)], "y int, m int, d int")
    found = parts.select(dates.date_of_parts(F.col("y"), F.col("m"), F.col("d"))).collect()
    assert [row[0] for row in found] == [None, datetime.date(2024, 2, 29), None]


def test_labels(spark):
    changes = spark.createDataFrame([(0.123,), (-0.25,), (0.0,), (None,)], "c double")
    rows = changes.select(text.balance_label(F.col("c")), text.signed_percent(F.col("c"))).collect()
    assert [tuple(row) for row in rows][:3] == [
        ("weekend-heavy", "+12%"), ("weekday-heavy", "-25%"), ("weekday-heavy", "+0%"),
    ]
    assert rows[3][0] is None


def wide_rows(spark, rows):
    """Wide table of (month, line, station, {column: value}); other hours NULL."""
    records = [
        (month, line, station, *[cells.get(name) for name in schemas.RAW_HOUR_COLUMNS], "2024-02-05")
        for month, line, station, cells in rows
    ]
    return spark.createDataFrame(records, schemas.HOURLY_WIDE)


def test_wide_has_52_columns():
    names = schemas.HOURLY_WIDE.names
    assert len(names) == 3 + 48 + 1
    assert names[3] == "04시-05시 승차인원" and names[50] == "03시-04시 하차인원"


def test_hourly_long(spark):
    wide = wide_rows(spark, [
        ("202401", "2", "강남 (역)", {"08시-09시 승차인원": "12.0", "08시-09시 하차인원": "x"}),
        ("202402", "2", "강남", {"23시-00시 하차인원": "5"}),
    ])
    long = reshape.hourly_long(wide)
    assert long.schema.names == schemas.HOURLY_LONG.names
    assert [f.dataType for f in long.schema] == [f.dataType for f in schemas.HOURLY_LONG]
    rows = long.collect()
    assert len(rows) == 2 * 48 and {row.station for row in rows} == {"강남"}
    counts = {(row.year_month.month, row.hour, row.direction): row["count"] for row in rows if row["count"]}
    assert counts == {(1, 8, "board"): 12, (2, 23, "alight"): 5}
    assert {(row.hour, row.direction) for row in rows} == {
        (hour, direction) for hour in range(24) for direction in ("board", "alight")
    }


def raw_trade(amount="12,500", year=2024, month=2, day=3, area="84.9", code="11680", floor=3):
    return (amount, 1999, year, month, day, "dong", "complex", area, "12", code, floor, code, "202402")


def test_trades_and_index(spark):
    raw = spark.createDataFrame([
        raw_trade("10", area="10"), raw_trade("30", area="10"), raw_trade("20", area="0"),
        raw_trade("40", day=31, area="10"), raw_trade("50", area="none"),
    ], schemas.TRADES_RAW)
    clean = reshape.trades_clean(raw)
    assert clean.schema.names == schemas.TRADES.names
    assert [f.dataType for f in clean.schema] == [f.dataType for f in schemas.TRADES]
    by_amount = {row.deal_krw: row for row in clean.collect()}
    assert by_amount[200_000].price_per_m2 is None and by_amount[200_000].area_m2 == 0.0
    assert by_amount[400_000].contract_date is None
    assert by_amount[500_000].area_m2 is None and by_amount[500_000].price_per_m2 is None
    index = prices.monthly_price_index(clean).collect()
    assert [tuple(row) for row in index] == [("11680", datetime.date(2024, 2, 1), 20_000.0)]


def test_empty_trades(spark):
    empty = reshape.trades_clean(spark.createDataFrame([], schemas.TRADES_RAW))
    assert empty.schema.names == schemas.TRADES.names and empty.count() == 0
    assert prices.monthly_price_index(empty).count() == 0


def test_exact_median_is_exact(spark):
    rng = random.Random(5)
    rows = []
    for group in range(40):
        size = 1 + group * 7
        near = [7.0 + rng.random() * 1e-9 for _ in range(size)]
        wild = [rng.choice([-1, 1]) * 10 ** rng.uniform(-8, 12) for _ in range(size)]
        ties = [float(rng.randint(-2, 2)) for _ in range(size)]
        rows += [(f"{kind}{group}", x) for kind, xs in (("n", near), ("w", wild), ("t", ties)) for x in xs]
    rows += [("t1", None), ("t1", float("nan")), (None, 3.0), ("only", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    found = {row.g: row.m for row in prices.exact_median(df, ["g"], "x", "m").collect()}
    wanted = {}
    for group, x in rows:
        if group is not None and x is not None and x == x:
            wanted.setdefault(group, []).append(x)
    assert found == {group: statistics.median(xs) for group, xs in wanted.items()}


def test_median_moves_only_rows_of_the_middle(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("x"))
    result = prices.exact_median(df, ["g"], "x", "m")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    above = plan.split("BroadcastHashJoin")[1]
    assert "hashpartitioning" not in above


def test_first_last_change(spark):
    index = spark.createDataFrame([
        ("a", datetime.date(2024, 2, 1), 3e6), ("a", datetime.date(2024, 1, 1), 2e6),
        ("b", datetime.date(2024, 1, 1), 5e6),
    ], schemas.PRICE_INDEX)
    changes = {row.gu_code: row for row in prices.price_changes(index).collect()}
    assert (changes["a"].start_price, changes["a"].end_price, changes["a"].change_pct) == (2.0, 3.0, 50.0)
    assert changes["b"].change_pct is None
    assert {row.gu_code: row.change_pct for row in prices.with_change(index).collect()} == {"a": 50.0, "b": None}


def test_column_guard(spark):
    with pytest.raises(KeyError, match="direction"):
        station_features(spark.createDataFrame([("a", 1, 2)], "station string, hour int, count long"))


def test_union_of_frames(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([(2, 3.0)], "x int, z double")
    empty = spark.createDataFrame([], "x int")
    both = tables.union_frames([left, empty, right])
    assert sorted(map(tuple, both.collect())) == [(1, "a", None), (2, None, 3.0)]


def test_fixed_tables():
    assert len(fixed.REGIONS) == 25 and len({code for _, code in fixed.REGIONS}) == 25
    assert [f for f in fixed.FEATURES] == schemas.FEATURES.names[2:]
