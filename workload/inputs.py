"""The given tables in the shape of raw and tidy ridership and sale tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapflow import fixed
from tapflow.dims import Focus, constant_table, region_dimension
from tapflow.operators.aggregates import hour_totals
from tapflow.operators.clusters import archetype_names, centroids_of
from tapflow.operators.features import station_features
from tapflow.operators.ordering import peak_hour
from tapflow.operators.reshape import daily_clean, trades_clean
from tapflow.schemas import HOURLY_WIDE, RAW_HOUR_COLUMNS

FOCUS = Focus({"click": "Click street", "view": "View point", "purchase": "Purchase plaza"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _direction() -> Column:
    return F.when(F.col("event_id") % 2 == 0, "alight").otherwise("board")


def _taps(events: DataFrame, station: Column, line: Column) -> DataFrame:
    return events.select(
        F.trunc("ts", "MM").alias("year_month"), line.alias("line"), station.alias("station"),
        F.hour("ts").alias("hour"), _direction().alias("direction"),
        F.floor("value").cast("bigint").alias("count"),
    )


def taps_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly long table with a station per user and a line per event type."""
    events = table(spark, sf_dir, "events")
    return _taps(events, F.col("user_id").cast("string"), F.col("event_type"))


def taps_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly long table with a station per event type and four lines."""
    events = table(spark, sf_dir, "events")
    return _taps(events, F.col("event_type"), F.concat(F.lit("L"), F.col("user_id") % 4))


def taps_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table over several years: a station per order priority, whole prices as taps."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.trunc("o_orderdate", "MM").alias("year_month"), F.col("o_orderpriority").alias("station"),
        F.floor("o_totalprice").cast("bigint").alias("count"),
    )


def taps_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly long table over several years: a station per order priority, hour and direction by
    the order's and the customer's number."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.trunc("o_orderdate", "MM").alias("year_month"), F.col("o_orderstatus").alias("line"), F.col("o_orderpriority").alias("station"),
        F.pmod("o_orderkey", F.lit(24)).cast("int").alias("hour"),
        F.when(F.col("o_custkey") % 2 == 0, "alight").otherwise("board").alias("direction"),
        F.floor("o_totalprice").cast("bigint").alias("count"),
    )


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hourly table: month, line, station with a bracketed alias, 48 text columns."""
    events = table(spark, sf_dir, "events")
    slot = F.format_string(
        "%02d시-%02d시 %s인원", F.hour("ts"), (F.hour("ts") + 1) % 24,
        F.when(F.col("event_id") % 2 == 0, "하차").otherwise("승차"),
    )
    named = events.select(
        F.date_format("ts", "yyyyMM").alias(fixed.RAW_MONTH),
        F.col("event_type").alias(fixed.RAW_LINE),
        F.concat(F.lit("Stop "), F.col("user_id"), F.lit(" (user)")).alias(fixed.RAW_STATION),
        slot.alias("slot"), F.floor("value").cast("bigint").alias("count"),
    )
    wide = named.groupBy(*fixed.RAW_ID_COLUMNS).pivot("slot", RAW_HOUR_COLUMNS).agg(F.sum("count"))
    return wide.select(
        *fixed.RAW_ID_COLUMNS,
        *[F.col(f"`{name}`").cast("string").alias(name) for name in RAW_HOUR_COLUMNS],
        F.lit("2024-02-05").alias(fixed.RAW_LOADED),
    ).to(HOURLY_WIDE)


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily table by date, line and event type; totals as texts."""
    events = table(spark, sf_dir, "events")
    taps = F.floor("value").cast("bigint")
    boarded = F.sum(F.when(F.col("event_id") % 2 == 1, taps).otherwise(0))
    alighted = F.sum(F.when(F.col("event_id") % 2 == 0, taps).otherwise(0))
    return events.groupBy(
        F.date_format("ts", "yyyyMMdd").alias(fixed.RAW_DAY),
        F.concat(F.lit("L"), F.col("user_id") % 4).alias(fixed.RAW_DAY_LINE),
        F.col("event_type").alias(fixed.RAW_DAY_STATION),
    ).agg(
        boarded.cast("string").alias(fixed.RAW_DAY_BOARD),
        alighted.cast("string").alias(fixed.RAW_DAY_ALIGHT),
    ).withColumn(fixed.RAW_DAY_LOADED, F.lit("20240205"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_clean(daily_raw(spark, sf_dir))


def trades_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sale records: a sale per line item, region of its supplier's nation, area of its part."""
    items = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    regions = region_dimension(spark).select(F.col("region_no").alias("s_nationkey"), "gu_code")
    placed = (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .join(suppliers, items.l_suppkey == suppliers.s_suppkey)
        .join(regions, "s_nationkey")
    )
    month = F.date_format("l_shipdate", "yyyyMM")
    return placed.select(
        F.format_number(F.floor("l_extendedprice").cast("bigint"), 0).alias(fixed.RAW_AMOUNT),
        (F.lit(1985) + F.pmod("l_partkey", F.lit(38))).cast("int").alias(fixed.RAW_BUILD_YEAR),
        F.year("l_shipdate").alias(fixed.RAW_YEAR),
        F.month("l_shipdate").alias(fixed.RAW_MONTH_NO),
        F.dayofmonth("l_shipdate").alias(fixed.RAW_DAY_NO),
        F.col("p_brand").alias(fixed.RAW_DONG),
        F.col("p_name").alias(fixed.RAW_COMPLEX),
        F.col("p_size").cast("string").alias(fixed.RAW_AREA),
        F.col("l_linenumber").cast("string").alias(fixed.RAW_LOT),
        F.col("gu_code").alias(fixed.RAW_AREA_CODE),
        F.col("l_linenumber").cast("int").alias(fixed.RAW_FLOOR),
        F.col("gu_code").alias(fixed.RAW_REGION_CODE),
        month.alias(fixed.RAW_QUERY_MONTH),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_clean(trades_raw(spark, sf_dir))


def focus_pair(spark: SparkSession) -> DataFrame:
    return constant_table(spark, ["station_a", "station_b"], [tuple(FOCUS.names)[:2]])


def features_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_features(taps_by_user(spark, sf_dir))


def given_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed assignment of users: the fifth of the day in which their peak hour lies."""
    peaks = peak_hour(hour_totals(taps_by_user(spark, sf_dir)))
    return peaks.select("station", F.floor(F.col("peak_hour") / 5).cast("int").alias("cluster"))


def given_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids_of(features_by_user(spark, sf_dir), given_clusters(spark, sf_dir))


def given_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station, cluster and cluster_name under the fixed assignment."""
    names = archetype_names(given_centroids(spark, sf_dir))
    return given_clusters(spark, sf_dir).join(names, "cluster")
