"""The table behind each chart; drawing is left to the caller.

Chart tables are filtered to the focus stations before any grouping, and the filter is
a membership test that reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapflow import fixed
from tapflow.dims import Focus, constant_table
from tapflow.functions.arrays import closed_ring
from tapflow.functions.numbers import millions, thousands
from tapflow.functions.text import hover_text
from tapflow.operators.aggregates import (
    annual_totals, cluster_hours, hour_totals, weekday_hour_surface, weekend_balance,
)
from tapflow.operators.distributions import ecdf, hour_samples, ks_p_values, ks_two_sample
from tapflow.operators.lookup import keep_entities, with_display_name
from tapflow.operators.ordering import peak_hour
from tapflow.operators.prices import price_changes, with_change
from tapflow.operators.reshape import direction_pivot, with_share
from tapflow.operators.scaling import min_max
from tapflow.staging import written


def named(df: DataFrame, focus: Focus) -> DataFrame:
    return with_display_name(df, focus.table(df.sparkSession))


def in_order(df: DataFrame, focus: Focus) -> DataFrame:
    """As ``named``, with the place of each focus station in the order they were given."""
    places = focus.table(df.sparkSession).select("station", "display_order")
    return named(df, focus).join(places, "station", "left")


def chart_a(long: DataFrame, daily: DataFrame, focus: Focus) -> DataFrame:
    """Weekday × hour cells of the focus stations and the largest value of all of them."""
    surface = weekday_hour_surface(focus.keep(long), focus.keep(daily))
    shared = F.max("value").over(Window.partitionBy())  # 168 rows per focus station
    return in_order(surface.withColumn("scale_max", shared), focus)


def chart_b(long: DataFrame, focus: Focus) -> DataFrame:
    """Hour share in percent of each focus station, with its peak hour and value."""
    hourly = with_share(hour_totals(focus.keep(long)), ["station"], "taps")
    shares = hourly.select("station", "hour", (F.col("share") * 100).alias("share_pct"))
    peaks = peak_hour(shares, "share_pct")
    return in_order(shares.join(peaks, "station"), focus)


def chart_c(long: DataFrame, focus: Focus) -> DataFrame:
    """Yearly totals in millions of each focus station."""
    totals = annual_totals(focus.keep(long))
    return in_order(totals, focus).withColumn("taps_millions", millions(F.col("taps")))


def chart_d(daily: DataFrame, focus: Focus) -> DataFrame:
    """Weekend balance of the focus stations with label and place in rising order."""
    balance = named(weekend_balance(focus.keep(daily)), focus)
    order = Window.orderBy("change", "station")  # focus stations only
    return balance.withColumn("bar_order", F.row_number().over(order))


def profile_rows(scaled: DataFrame, keep: list[str], axes: list[str]) -> DataFrame:
    """One row per kept key with the closed ring of six values and of axis names."""
    values = closed_ring(F.array(*[F.col(name) for name in fixed.FEATURES]))
    names = closed_ring(F.array(*[F.lit(axis) for axis in axes]))
    return scaled.select(*keep, values.alias("r"), names.alias("theta"))


def chart_e(features: DataFrame, focus: Focus) -> DataFrame:
    """Min–max feature profile of each focus station; constant features keep their value."""
    scaled = min_max(focus.keep(features), fixed.FEATURES, "keep")
    return profile_rows(in_order(scaled, focus), ["station", "display_name", "display_order"], fixed.PROFILE_AXES)


def chart_f_steps(long: DataFrame, focus: Focus) -> DataFrame:
    """Step curve of each focus station's 24 hourly shares."""
    return in_order(ecdf(hour_samples(focus.keep(long))), focus)


def chart_f_ks(long: DataFrame, pair: DataFrame) -> DataFrame:
    """KS row of the (station_a, station_b) pair."""
    both = pair.select(F.explode(F.array("station_a", "station_b")).alias("station")).distinct()
    samples = hour_samples(keep_entities(long, both))
    return ks_p_values(ks_two_sample(samples, pair))


def chart_g(long: DataFrame, focus: Focus, hour: int = fixed.PEAK_HOUR) -> DataFrame:
    """Alightings (negative) and boardings at one hour in thousands; a silent station has 0."""
    at_hour = focus.keep(long.where(F.col("hour") == hour))
    stations = focus.table(long.sparkSession).select("station")
    sums = stations.join(direction_pivot(at_hour, ["station"]), "station", "left")
    return in_order(sums.na.fill(0, fixed.DIRECTIONS), focus).select(
        "station", "display_name", "display_order",
        thousands(-F.col("alight")).alias("alight_thousands"),
        thousands(F.col("board")).alias("board_thousands"),
    )


def _point_rows(features: DataFrame, labels: DataFrame, plane: DataFrame, focus: Focus) -> DataFrame:
    points = features.join(labels.select("station", "cluster", "cluster_name"), "station").join(plane, "station")
    return named(points, focus).withColumn("in_focus", focus.holds())


def chart_i(features: DataFrame, labels: DataFrame, plane: DataFrame, focus: Focus) -> DataFrame:
    """Projection points with cluster, hover text and the annotation of focus stations."""
    points = _point_rows(features, labels, plane, focus)
    text = hover_text(
        F.col("station"), F.col("display_name"), F.col("morning_peak_intensity"),
        F.col("late_night_share"), F.col("directional_asymmetry_peak"), F.col("weekend_weekday_ratio"),
    )
    return points.select(
        "station", "x", "y", "cluster", "cluster_name", text.alias("hover"),
        F.when(F.col("in_focus"), F.col("display_name")).alias("annotation"),
    )


def chart_j(centroids: DataFrame, names: DataFrame) -> DataFrame:
    """Min–max centroid profile of each cluster (1e-9 added to every range)."""
    scaled = min_max(centroids, fixed.FEATURES, "eps").join(names, "cluster")
    return profile_rows(scaled, ["cluster", "cluster_name"], fixed.CENTROID_AXES)


def chart_k(features: DataFrame, labels: DataFrame, plane: DataFrame, focus: Focus) -> DataFrame:
    """Projection points in two layers: all stations behind, focus stations in front."""
    points = _point_rows(features, labels, plane, focus)
    layers = F.when(F.col("in_focus"), F.array(F.lit("background"), F.lit("focus"))).otherwise(
        F.array(F.lit("background"))
    )
    return points.select(
        F.explode(layers).alias("layer"), "station", "display_name", "x", "y", "cluster", "cluster_name"
    )


def chart_m(index: DataFrame, region_labels: DataFrame) -> DataFrame:
    """Monthly price in millions by region, with the region's percent change."""
    series = with_change(index).select(
        "gu_code", "year_month", millions(F.col("median_price_per_m2")).alias("price_millions"), "change_pct"
    )
    return with_display_name(series, region_labels, "gu_code")


def chart_n(index: DataFrame, region_labels: DataFrame) -> DataFrame:
    """Start, end and percent change by region, placed by rising change of price.

    The placing window runs over one row per region.
    """
    changes = with_display_name(price_changes(index), region_labels, "gu_code")
    rise = F.col("end_price") - F.col("start_price")
    order = Window.orderBy(rise, "gu_code")
    return changes.select(
        "gu_code", "display_name", "start_price", "end_price", "change_pct",
        F.row_number().over(order).alias("slope_order"),
    )


def price_region_labels(spark: SparkSession) -> DataFrame:
    return constant_table(spark, ["gu_code", "en_name"], list(fixed.PRICE_REGION_LABELS.items()))


def chart_o(long: DataFrame, labels: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Boardings by cluster and hour in stacking order, with the top of each stack.

    Clusters outside the order follow it by name. Windows run over one row per cluster, or
    per cluster and hour.
    """
    names = fixed.STACK_ORDER if order is None else order
    listed = constant_table(long.sparkSession, ["cluster_name", "listed"],
                            [(name, place) for place, name in enumerate(names)])
    others = Window.partitionBy(F.col("listed").isNull()).orderBy("cluster_name")
    places = labels.select("cluster_name").distinct().join(listed, "cluster_name", "left").select(
        "cluster_name",
        F.coalesce("listed", F.row_number().over(others) - 1 + len(names)).alias("stack_order"),
    )
    rows = cluster_hours(long, labels).join(places, "cluster_name")
    upto = Window.partitionBy("hour").orderBy("stack_order").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("stack_top", F.sum("boardings").over(upto))


def focus_rows(long: DataFrame, focus: Focus) -> DataFrame:
    """The long rows of the focus stations, written once for all charts that draw only these."""
    return written(focus.keep(long), "focus_rows")


def section_4(long: DataFrame, daily: DataFrame, focus: Focus) -> dict[str, DataFrame]:
    """``long`` may be the table or its focus rows, as for section 5."""
    return {"A": chart_a(long, daily, focus), "B": chart_b(long, focus)}


def section_5(long: DataFrame, daily: DataFrame, features: DataFrame, focus: Focus,
              pair: DataFrame) -> dict[str, DataFrame]:
    return {
        "C": chart_c(long, focus), "D": chart_d(daily, focus), "E": chart_e(features, focus),
        "F": chart_f_steps(long, focus), "F_ks": chart_f_ks(long, pair), "G": chart_g(long, focus),
    }


def section_6(features: DataFrame, labels: DataFrame, centroids: DataFrame, names: DataFrame,
              plane: DataFrame, index: DataFrame, long: DataFrame, focus: Focus) -> dict[str, DataFrame]:
    regions = price_region_labels(long.sparkSession)
    return {
        "I": chart_i(features, labels, plane, focus), "J": chart_j(centroids, names),
        "K": chart_k(features, labels, plane, focus), "M": chart_m(index, regions),
        "N": chart_n(index, regions), "O": chart_o(long, labels),
    }
