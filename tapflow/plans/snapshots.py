"""Stage snapshots: a preview and a payload table for each of six stages."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tapflow import fixed
from tapflow.dims import Focus
from tapflow.functions.numbers import ratio_or_zero
from tapflow.operators.aggregates import cluster_sizes, column_distinctiveness
from tapflow.operators.clusters import Clustering, choose_k_and_cluster, project_2d
from tapflow.operators.features import station_features
from tapflow.operators.lookup import assign_station_id, station_ids
from tapflow.operators.ordering import preview, top_columns
from tapflow.operators.reshape import dense_hours, hour_columns, hour_profile, hourly_long, slot_total
from tapflow.operators.scaling import min_max
from tapflow.plans.chart_tables import in_order, named, profile_rows
from tapflow.sources.tables import write_snapshot
from tapflow.staging import written


@dataclass(frozen=True)
class Stage:
    name: str
    label: str
    description: str
    preview: DataFrame
    payload: DataFrame


def raw_shape(wide: DataFrame) -> DataFrame:
    """Number of identity, hour and other columns of the wide table, and its rows."""
    n_hours = len(hour_columns(wide))
    n_ids = len([name for name in wide.columns if name in fixed.RAW_ID_COLUMNS])
    counts = [n_ids, n_hours, len(wide.columns) - n_ids - n_hours]
    kinds = [(place + 1, kind, n) for place, (kind, n) in enumerate(zip(fixed.COLUMN_KINDS, counts))]
    cells = [
        F.struct(F.lit(order).alias("kind_order"), F.lit(kind).alias("kind"), F.lit(n).alias("n_columns"))
        for order, kind, n in kinds
    ]
    return wide.agg(F.count(F.lit(1)).alias("n_rows")).select(F.inline(F.array(*cells)), "n_rows")


def top_column_bars(ranked: DataFrame) -> DataFrame:
    return top_columns(ranked).select("rank", "column_label", "cv", "distinctive")


def flow_lines(long: DataFrame, focus: Focus) -> DataFrame:
    """Hour share in percent of each focus station on the dense day, zeros without taps."""
    profile = hour_profile(focus.keep(long), ["station"])
    dense = focus.table(long.sparkSession).select("station").join(profile, "station", "left").na.fill(0)
    rows = dense_hours(dense.withColumn("total", slot_total()), ["station", "total"])
    share = F.round(ratio_or_zero(F.col("taps"), F.col("total")) * 100, 2)
    return in_order(rows.select("station", "hour", share.alias("share_pct")), focus)


def feature_profiles(features: DataFrame, focus: Focus) -> DataFrame:
    """Min–max profiles of the focus stations at 3 digits; constant features become 0."""
    scaled = min_max(focus.keep(features), fixed.FEATURES, "zero")
    rounded = scaled.withColumns({name: F.round(name, 3) for name in fixed.FEATURES})
    return profile_rows(in_order(rounded, focus), ["station", "display_name", "display_order"], fixed.SNAPSHOT_AXES)


def cluster_bars(labels: DataFrame) -> DataFrame:
    return cluster_sizes(labels).orderBy("cluster_name")


def cluster_points(labels: DataFrame, plane: DataFrame, focus: Focus) -> DataFrame:
    """Points by cluster with text and focus flag, one row each so that a cluster of any
    size stays spread over tasks."""
    points = labels.select("station", "cluster", "cluster_name").join(plane, "station")
    flagged = named(points, focus).withColumn("in_focus", focus.holds())
    return flagged.select(
        "cluster_name", "station", "display_name", F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"), "in_focus",
    )


def build_stages(wide: DataFrame, focus: Focus, k_range: tuple[int, int] = (2, 8),
                 starts: int = 10, seed: int = 42) -> list[Stage]:
    """Run the whole pipeline on a wide table and describe each stage.

    The long table is written once to the shared folder; ids, features, previews and
    payloads read it from there.
    """
    long = written(hourly_long(wide), "ridership_long")
    ids = written(station_ids(long), "station_ids")
    # Ids join the feature rows, one per station, and not the facts.
    features = assign_station_id(station_features(long), ids)
    return described_stages(wide, long, ids, choose_k_and_cluster(features, k_range, starts, seed), focus)


def described_stages(wide: DataFrame, long: DataFrame, ids: DataFrame, found: Clustering, focus: Focus) -> list[Stage]:
    """Describe each stage from tables and a clustering that are there already.

    Only the ranking of columns is computed, written once and used twice.
    """
    ranked = written(column_distinctiveness(long), "ranked_columns")
    n_rows = long.count()

    def identified(df: DataFrame) -> DataFrame:
        return assign_station_id(df, ids)

    plane = project_2d(found.scaled)
    points = cluster_points(found.labels, plane, focus)
    keys = ["year_month", "line", "station", "hour", "direction"]
    parts = {
        "raw": (preview(wide, fixed.RAW_ID_COLUMNS), raw_shape(wide)),
        "standardized": (preview(ranked, ["rank"]), top_column_bars(ranked)),
        "normalized": (preview(long, keys, complete=identified), flow_lines(long, focus)),
        "features": (preview(found.features, ["station"]), feature_profiles(found.features, focus)),
        "clustered": (preview(found.labels, ["station"]), cluster_bars(found.labels)),
        "projected": (preview(points, ["station"]), points),
    }
    return [
        Stage(name, label, fixed.STAGE_DESCRIPTIONS[name].format(rows=n_rows, k=found.k), *parts[name])
        for name, label in fixed.STAGES
    ]


def snapshot_info(wide: DataFrame, source: str, generated_at: str | None = None) -> DataFrame:
    """One row about a snapshot: when it was made (UTC), from what, and over how many months."""
    now = generated_at or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return wide.agg(F.count_distinct(fixed.RAW_MONTH).cast("int").alias("n_months")).select(
        F.lit(now).alias("generated_at"), F.lit(source).alias("source"), "n_months"
    )


def write_stages(stages: list[Stage], folder: str, info: DataFrame | None = None) -> list[str]:
    """Write preview and payload of each stage, and the snapshot's info, as JSON lines under ``folder``."""
    paths = [] if info is None else [write_snapshot(info, f"{folder.rstrip('/')}/info")]
    for stage in stages:
        for part, df in (("preview", stage.preview), ("payload", stage.payload)):
            named = df.select(
                F.lit(stage.name).alias("stage"), F.lit(stage.label).alias("stage_label"),
                F.lit(stage.description).alias("stage_description"), "*",
            )
            paths.append(write_snapshot(named, f"{folder.rstrip('/')}/{stage.name}/{part}"))
    return paths


def stage_json(stage: Stage) -> DataFrame:
    """Payload rows as one JSON text each."""
    return stage.payload.select(F.to_json(F.struct("*")).alias("json"))
