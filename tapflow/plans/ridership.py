"""The ridership and price pipelines from raw tables to written stage tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tapflow.operators.clusters import Clustering, choose_k_and_cluster
from tapflow.operators.features import station_features
from tapflow.operators.lookup import assign_station_id, station_ids
from tapflow.operators.prices import monthly_price_index
from tapflow.operators.reshape import daily_clean, hourly_long, trades_clean
from tapflow.schemas import HOURLY_LONG
from tapflow.sources.tables import read_stage, write_stage


@dataclass(frozen=True)
class StageTables:
    """Paths of the written stage tables."""

    ridership_long: str
    station_ids: str
    daily: str
    features: str
    price_index: str
    cluster_labels: str
    cluster_centroids: str
    rejects: str


def run(spark: SparkSession, wide: DataFrame, daily_raw: DataFrame, trades_raw: DataFrame, folder: str,
        k_range: tuple[int, int] = (2, 8), starts: int = 10, seed: int = 42) -> tuple[StageTables, Clustering]:
    """Write every stage table; each stage reads the written one before it, so no stage
    is computed twice and a restart can begin at any of them."""
    at = {name: f"{folder.rstrip('/')}/{name}.parquet" for name in StageTables.__dataclass_fields__}
    write_stage(hourly_long(wide), at["ridership_long"], partition_by=["year_month"], sort_by=["station", "hour"])
    long = read_stage(spark, at["ridership_long"], HOURLY_LONG)
    write_stage(station_ids(long), at["station_ids"])
    write_stage(daily_clean(daily_raw), at["daily"], sort_by=["station", "date"])
    write_stage(monthly_price_index(trades_clean(trades_raw)), at["price_index"], sort_by=["gu_code", "year_month"])
    # Ids join the feature rows, one per station, and not the facts.
    features = assign_station_id(station_features(long), read_stage(spark, at["station_ids"]))
    write_stage(features, at["features"], sort_by=["station"])
    found = choose_k_and_cluster(read_stage(spark, at["features"]), k_range, starts, seed)
    write_stage(found.labels, at["cluster_labels"], sort_by=["station"])
    write_stage(found.centroids, at["cluster_centroids"], sort_by=["cluster"])
    write_stage(found.rejects, at["rejects"])
    return StageTables(**at), found
