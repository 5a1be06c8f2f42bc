"""Schemas of the stage tables and the column guard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

from tapflow import fixed


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


def hour_column(hour: int, korean_direction: str) -> str:
    """Raw name of one hour column."""
    return f"{hour:02d}시-{(hour + 1) % 24:02d}시 {korean_direction}인원"


# The operating day runs from 04 to 04, boardings before alightings.
RAW_HOUR_COLUMNS = [
    hour_column((4 + step) % 24, korean)
    for step in range(24)
    for korean in fixed.DIRECTION_OF
]

HOURLY_WIDE = _struct(
    [(name, T.StringType()) for name in fixed.RAW_ID_COLUMNS]
    + [(name, T.StringType()) for name in RAW_HOUR_COLUMNS]
    + [(fixed.RAW_LOADED, T.StringType())]
)

HOURLY_LONG = _struct([
    ("year_month", T.DateType()),
    ("line", T.StringType()),
    ("station", T.StringType()),
    ("hour", T.IntegerType()),
    ("direction", T.StringType()),
    ("count", T.LongType()),
])

DAILY_RAW = _struct([
    (name, T.StringType())
    for name in (
        fixed.RAW_DAY, fixed.RAW_DAY_LINE, fixed.RAW_DAY_STATION,
        fixed.RAW_DAY_BOARD, fixed.RAW_DAY_ALIGHT, fixed.RAW_DAY_LOADED,
    )
])

DAILY = _struct([
    ("date", T.DateType()),
    ("weekday", T.IntegerType()),
    ("line", T.StringType()),
    ("station", T.StringType()),
    ("board_total", T.LongType()),
    ("alight_total", T.LongType()),
])

TRADES_RAW = _struct([
    (fixed.RAW_AMOUNT, T.StringType()),
    (fixed.RAW_BUILD_YEAR, T.IntegerType()),
    (fixed.RAW_YEAR, T.IntegerType()),
    (fixed.RAW_MONTH_NO, T.IntegerType()),
    (fixed.RAW_DAY_NO, T.IntegerType()),
    (fixed.RAW_DONG, T.StringType()),
    (fixed.RAW_COMPLEX, T.StringType()),
    (fixed.RAW_AREA, T.StringType()),
    (fixed.RAW_LOT, T.StringType()),
    (fixed.RAW_AREA_CODE, T.StringType()),
    (fixed.RAW_FLOOR, T.IntegerType()),
    (fixed.RAW_REGION_CODE, T.StringType()),
    (fixed.RAW_QUERY_MONTH, T.StringType()),
])

TRADES = _struct([
    ("contract_date", T.DateType()),
    ("gu_code", T.StringType()),
    ("dong", T.StringType()),
    ("complex", T.StringType()),
    ("area_m2", T.DoubleType()),
    ("deal_krw", T.LongType()),
    ("price_per_m2", T.DoubleType()),
    ("floor", T.IntegerType()),
    ("build_year", T.IntegerType()),
])

PRICE_INDEX = _struct([
    ("gu_code", T.StringType()),
    ("year_month", T.DateType()),
    ("median_price_per_m2", T.DoubleType()),
])

FEATURES = _struct(
    [("station", T.StringType()), ("station_id", T.LongType())]
    + [(name, T.DoubleType()) for name in fixed.FEATURES]
)

LABELS = _struct([
    ("station", T.StringType()),
    ("station_id", T.LongType()),
    ("cluster", T.IntegerType()),
    ("cluster_name", T.StringType()),
])

RESULT = _struct([("CODE", T.StringType()), ("MESSAGE", T.StringType())])


def page_schema(row: T.StructType = HOURLY_WIDE, envelope: str = fixed.PAGE_ENVELOPE) -> T.StructType:
    """Schema of one landed response page around rows of ``row``."""
    body = _struct([
        ("list_total_count", T.LongType()),
        ("RESULT", RESULT),
        ("row", T.ArrayType(row)),
    ])
    return _struct([(envelope, body)])


def require_columns(df: DataFrame, names: Iterable[str], who: str) -> DataFrame:
    """Return ``df``, or raise ``KeyError`` naming the columns it lacks."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise KeyError(f"{who} lacks columns {absent}; it has {df.columns}")
    return df
