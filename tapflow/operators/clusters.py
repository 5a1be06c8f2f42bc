"""k-means with choice of k, archetype names and the 2-D projection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow import fixed
from tapflow.dims import constant_table
from tapflow.operators.features import complete_features
from tapflow.operators.kmeans import best_runs, with_assignments
from tapflow.operators.ordering import average_rank, dedupe_names
from tapflow.operators.scaling import StandardScaler, fit_standard
from tapflow.operators.silhouette import centroid_silhouette, mean_moments_silhouette, mean_silhouette
from tapflow.staging import checkpointed


SCORES = ("exact", "centroid", "moments")


@dataclass(frozen=True)
class Clustering:
    """Results of the sweep; every table has at most one row per station."""

    features: DataFrame       # complete feature rows
    rejects: DataFrame        # rows with an undefined feature
    scaled: DataFrame         # station, its code, and standardised point
    scaler: StandardScaler
    sweep: DataFrame          # k, wcss, silhouette, passes, converged
    k: int
    centroids: DataFrame      # cluster and six features in original units
    centroids_scaled: DataFrame
    names: DataFrame          # cluster, cluster_name
    labels: DataFrame         # station [, station_id], cluster, cluster_name


def archetype_names(centroids: DataFrame) -> DataFrame:
    """Name each centroid by the first rule that holds; repeated names get a number.

    A shared first place counts for none of those that share it. Windows run over the
    k centroid rows.
    """
    ranked = centroids.select(
        "cluster", "directional_asymmetry_peak", "morning_peak_intensity",
        average_rank("late_night_share").alias("by_night"),
        average_rank("weekend_weekday_ratio").alias("by_weekend"),
        average_rank("cv_hourly", descending=False).alias("by_flatness"),
    )
    sharp = F.col("morning_peak_intensity") > fixed.MORNING_LIMIT
    asymmetry = F.col("directional_asymmetry_peak")
    base = (
        F.when((F.col("by_night") == 1) | (F.col("by_weekend") == 1), fixed.NIGHTLIFE)
        .when((asymmetry > fixed.ASYMMETRY_LIMIT) & sharp, fixed.BUSINESS)
        .when((asymmetry < -fixed.ASYMMETRY_LIMIT) & sharp, fixed.RESIDENTIAL)
        .when(F.col("by_flatness") == 1, fixed.INTERCHANGE)
        .otherwise(fixed.MIXED)
    )
    named = ranked.select("cluster", base.alias("archetype"))
    return dedupe_names(named, "archetype", "cluster", "cluster_name").select("cluster", "cluster_name")


def centroids_of(features: DataFrame, assignment: DataFrame) -> DataFrame:
    """Mean feature values by cluster of a given (station, cluster) assignment."""
    return features.join(assignment, "station").groupBy("cluster").agg(
        *[F.avg(name).alias(name) for name in fixed.FEATURES]
    )


def with_names(assignment: DataFrame, names: DataFrame) -> DataFrame:
    """Add the cluster name; there is one name per cluster."""
    return assignment.join(names, "cluster", "left")


def _centroid_table(spark: SparkSession, rows: list[np.ndarray]) -> DataFrame:
    return spark.createDataFrame(
        [(number, *map(float, row)) for number, row in enumerate(rows)],
        "cluster int, " + ", ".join(f"{name} double" for name in fixed.FEATURES),
    )


def choose_k_and_cluster(features: DataFrame, k_range: tuple[int, int] = (2, 8), starts: int = 10,
                         seed: int = 42, score: str = "exact", max_passes: int = 300) -> Clustering:
    """Standardise, sweep k (inclusive), keep the k of the best silhouette, name the clusters.

    ``score`` names the silhouette: ``exact`` compares all points with each other and is
    quadratic in the number of stations; ``moments`` is exact for squared distances and
    linear; ``centroid`` compares points with the centres and is linear. A chosen k whose run did not settle within ``max_passes`` stops the job.

    Features are one row per station: they are written to the checkpoint folder, so the
    passes and a lost executor never go back to the facts. Clusters are numbered by
    falling size, then by centroid, so that numbers do not depend on the draw.
    """
    if score not in SCORES:
        raise ValueError(f"score must be one of {SCORES}")
    spark = features.sparkSession
    features = checkpointed(features)
    complete, rejects = complete_features(features)
    scaler = fit_standard(complete, fixed.FEATURES)
    scaled = checkpointed(
        scaler.transform(complete).select(
            "station", F.xxhash64("station").alias("code"), F.array(*fixed.FEATURES).alias("point")
        )
    )
    ks = list(range(k_range[0], k_range[1] + 1))
    points = scaled.select("code", "point")
    if points.select("point").distinct().limit(ks[-1] + 1).count() <= ks[-1]:
        raise ValueError(f"fewer distinct feature rows than needed for k up to {ks[-1]}")
    best = best_runs(points, len(fixed.FEATURES), ks, starts, seed, max_passes)

    names_of = {k: f"k{k}" for k in ks}
    assigned = checkpointed(
        with_assignments(scaled, {names_of[k]: best[k].centers for k in ks})
    )
    if score == "exact":
        means = mean_silhouette(assigned, "station", "point", list(names_of.values()))
    elif score == "moments":
        means = mean_moments_silhouette(assigned, "point", list(names_of.values()))
    else:
        means = centroid_silhouette(assigned, "point", {names_of[k]: dict(enumerate(best[k].centers.tolist())) for k in ks})
    scores = {row["assignment"]: row["silhouette"] for row in means.collect()}  # one row per k
    sweep = spark.createDataFrame(
        [(k, float(best[k].cost), scores[names_of[k]], best[k].passes, best[k].converged) for k in ks],
        "k int, wcss double, silhouette double, passes int, converged boolean",
    )
    chosen = best[best_k(sweep).first()["k"]]
    if not chosen.converged:
        raise RuntimeError(f"k-means for k = {chosen.k} did not settle in {max_passes} passes")

    order = sorted(range(chosen.k), key=lambda i: (-chosen.sizes[i], tuple(chosen.centers[i])))
    renumbered = constant_table(spark, ["found", "cluster"], [(old, new) for new, old in enumerate(order)])
    centroids_scaled = _centroid_table(spark, [chosen.centers[i] for i in order])
    centroids = scaler.inverse(centroids_scaled)
    names = archetype_names(centroids)
    identity = [name for name in ("station", "station_id") if name in features.columns]
    assignment = assigned.select("station", F.col(names_of[chosen.k]).alias("found")).join(renumbered, "found")
    labels = with_names(
        complete.select(*identity).join(assignment.select("station", "cluster"), "station"),
        F.broadcast(names),  # one row per cluster, at most k_range[1]
    ).select(*identity, "cluster", "cluster_name")
    return Clustering(complete, rejects, scaled, scaler, sweep, chosen.k, centroids, centroids_scaled,
                      names, labels)


def best_k(sweep: DataFrame) -> DataFrame:
    """The k of the largest silhouette, the smallest k on ties."""
    return sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("k"))


def project_2d(scaled: DataFrame) -> DataFrame:
    """First two principal components of the standardised points: station, x, y."""
    vectors = scaled.select("station", array_to_vector("point").alias("vector"))
    model = PCA(k=2, inputCol="vector", outputCol="plane").fit(vectors)
    plane = vector_to_array("plane")
    return model.transform(vectors).select(
        "station", plane[0].alias("x"), plane[1].alias("y")
    )
