"""Scaling, silhouettes, k-means, archetypes, projection and snapshots."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow import dims, fixed
from tapflow.operators import clusters, kmeans, scaling, silhouette
from tapflow.plans import chart_tables as charts, job, ridership, snapshots
from workload import inputs


def points_frame(spark, points, labels=None):
    rows = [(f"s{i:04d}", [float(x) for x in p], *([int(labels[i])] if labels is not None else []))
            for i, p in enumerate(points)]
    kind = "station string, point array<double>" + (", label int" if labels is not None else "")
    return spark.createDataFrame(rows, kind)


def blobs(n, centers, spread=0.2, seed=0):
    rng = np.random.default_rng(seed)
    labels = np.arange(n) % len(centers)
    return np.asarray(centers)[labels] + rng.normal(0, spread, (n, len(centers[0]))), labels


def silhouette_by_hand(points, labels):
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    scores = []
    for i, label in enumerate(labels):
        own = labels == label
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = gaps[i, own].sum() / (own.sum() - 1)
        b = min(gaps[i, labels == other].mean() for other in set(labels) if other != label)
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


@pytest.mark.parametrize("tile_rows", [1024, 17])
def test_silhouette_against_brute_force(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(silhouette, "TILE_ROWS", tile_rows)
    points, labels = blobs(60, [(0, 0, 0), (2, 1, 0), (0, 3, 1)], 0.9)
    labels[7] = 9  # a cluster of one
    other = np.arange(60) % 2
    df = points_frame(spark, points, labels).withColumn(
        "other", (F.substring("station", 2, 4).cast("int") % 2)
    )
    found = {r.assignment: r.silhouette
             for r in silhouette.mean_silhouette(df, "station", "point", ["label", "other"]).collect()}
    assert math.isclose(found["label"], silhouette_by_hand(points, labels), abs_tol=1e-12)
    assert math.isclose(found["other"], silhouette_by_hand(points, other), abs_tol=1e-12)


def test_silhouette_of_close_points_far_from_the_middle(spark):
    """Copies and points a millionth apart keep their digits."""
    rng = np.random.default_rng(8)
    points = np.repeat(rng.normal(0, 5, (30, 20)), 4, axis=0)
    points[1::4] += rng.normal(0, 1e-6, (30, 20))
    labels = np.arange(120) // 2 % 8
    df = points_frame(spark, points, labels)
    found = silhouette.mean_silhouette(df, "station", "point", ["label"]).first()
    assert math.isclose(found.silhouette, silhouette_by_hand(points, labels), rel_tol=1e-9, abs_tol=1e-12)


def test_silhouette_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "TILE_ROWS", 8)
    points, labels = blobs(400, [(0, 0), (5, 5)], 1.0)
    df = points_frame(spark, points, labels)
    for held in (8_000_000, 1):  # 1: sums are handed on after each batch
        monkeypatch.setattr(silhouette, "HELD_SUMS", held)
        found = silhouette.mean_silhouette(df, "station", "point", ["label"])
        assert math.isclose(found.first().silhouette, silhouette_by_hand(points, labels), abs_tol=1e-12)
    gaps = silhouette._distances(points, points, (points ** 2).sum(1), (points ** 2).sum(1))
    assert np.allclose(gaps, np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)), rtol=1e-9, atol=0)


def test_silhouette_sends_blocks_and_no_sums(spark, monkeypatch):
    """Tasks return scores, not a sum for each point and cluster, and points travel in blocks.

    A repeated key counts as one point with the sum of its distances; a row without a key is
    met but not scored.
    """
    monkeypatch.setattr(silhouette, "TILE_ROWS", 8)
    points, labels = blobs(90, [(0, 0), (3, 1), (1, 4)], 1.0)
    df = points_frame(spark, points, labels)
    plan = silhouette.silhouette_points(df, "station", "point", ["label"])._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    rows = df.select(F.col("station").alias("key"), F.col("point").alias("vector"), F.array(F.col("label").cast("string")).alias("codes"))
    assert silhouette._blocks(rows, 1, ["label"]).count() == 1

    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    twice = df.withColumn("station", F.when(F.col("station") == "s0003", "s0000").when(F.col("station") != "s0001", F.col("station")))
    found = {r.key: r.silhouette for r in silhouette.silhouette_points(twice, "station", "point", ["label"]).collect()}
    assert len(found) == 88 and None not in found
    total = [(gaps[0] + gaps[3])[labels == c].sum() for c in range(3)]
    a, b = total[0] / 29, min(total[1], total[2]) / 30
    assert math.isclose(found["s0000"], (b - a) / max(a, b), rel_tol=1e-9)
    a, b = gaps[2][labels == 2].sum() / 29, min(gaps[2][labels == c].mean() for c in (0, 1))
    assert math.isclose(found["s0002"], (b - a) / max(a, b), rel_tol=1e-9)


def test_nearest_takes_the_first_of_equal_centres():
    rng = np.random.default_rng(2)
    points, centers = rng.normal(size=(500, 6)), rng.normal(size=(7, 6))
    centers[5] = centers[2]
    squares = kmeans._squares(points, centers)
    number, least = kmeans._nearest(points, centers)
    assert (number == squares.argmin(axis=1)).all() and (least == squares.min(axis=1)).all()


def test_wcss(spark):
    points, labels = blobs(50, [(0, 0), (5, 5)], 1.0)
    found = {r.cluster: (r.n_points, r.wcss)
             for r in silhouette.wcss(points_frame(spark, points, labels), "point", "label").collect()}
    for label in (0, 1):
        part = points[labels == label]
        assert found[label][0] == len(part)
        assert math.isclose(found[label][1], ((part - part.mean(0)) ** 2).sum(), rel_tol=1e-12)


def test_kmeans_finds_blobs_wherever_rows_lie(spark):
    points, labels = blobs(90, [(0, 0), (10, 0), (0, 10)])
    df = points_frame(spark, points).withColumn("code", F.xxhash64("station"))
    results = []
    for parts in (1, 7):
        best = kmeans.best_runs(df.repartition(parts), 2, [2, 3, 4], 3, seed=5)
        results.append({k: (round(run.cost, 6), sorted(run.sizes.tolist())) for k, run in best.items()})
    assert results[0] == results[1]
    assert results[0][3][1] == [30, 30, 30]
    costs = [results[0][k][0] for k in (2, 3, 4)]
    assert costs == sorted(costs, reverse=True)
    best = kmeans.best_runs(df, 2, [3], 3, seed=5)[3]
    assert math.isclose(
        best.cost, sum(((points[labels == i] - points[labels == i].mean(0)) ** 2).sum() for i in range(3)),
        rel_tol=1e-9,
    )


def test_standard_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, c double")
    scaler = scaling.fit_standard(df, ["x", "c"])
    scaled = scaler.transform(df).collect()
    x = np.array([1.0, 2.0, 6.0])
    assert np.allclose([r.x for r in scaled], (x - x.mean()) / x.std())
    assert [r.c for r in scaled] == [0.0, 0.0, 0.0]
    back = scaler.inverse(scaler.transform(df)).collect()
    assert np.allclose([(r.x, r.c) for r in back], [(1, 5), (2, 5), (6, 5)])


def test_min_max_variants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "x double, c double")
    found = {kind: [(round(r.x, 6), r.c) for r in scaling.min_max(df, ["x", "c"], kind).collect()]
             for kind in scaling.ON_CONSTANT}
    assert found == {
        "keep": [(0.0, 5.0), (1.0, 5.0), (0.5, 5.0)], "zero": [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)],
        "eps": [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)],
    }
    with pytest.raises(ValueError):
        scaling.min_max(df, ["x"], "drop")


def centroid_frame(spark, rows):
    """Rows of (AM intensity, E3, late-night, asymmetry, CV); evening intensity is not used."""
    return spark.createDataFrame(
        [(i, am, 0.1, ratio, late, asym, cv) for i, (am, ratio, late, asym, cv) in enumerate(rows)],
        "cluster int, " + ", ".join(f"{name} double" for name in fixed.FEATURES),
    )


def names_of(spark, rows):
    return [r.cluster_name for r in clusters.archetype_names(centroid_frame(spark, rows)).orderBy("cluster").collect()]


def test_archetypes(spark):
    assert names_of(spark, [
        (0.2, 1.0, 0.1, 0.6, 0.9), (0.05, 9.0, 0.4, 0.9, 0.8), (0.2, 1.0, 0.1, -0.5, 0.7),
        (0.2, 1.0, 0.1, 0.5, 0.6), (0.05, 1.0, 0.1, 0.9, 0.1), (0.05, 1.0, 0.1, 0.0, 0.5),
    ]) == [
        "Business District", "Nightlife District", "Residential Commuter", "Business District 2",
        "Transit Interchange", "Mixed Residential-Retail",
    ]


def test_shared_first_place_counts_for_none(spark):
    rows = [(0.05, 5.0, 0.4, 0.0, 0.5), (0.05, 5.0, 0.4, 0.0, 0.5), (0.05, 1.0, 0.1, 0.0, 0.9)]
    assert names_of(spark, rows) == [
        "Mixed Residential-Retail", "Mixed Residential-Retail 2", "Mixed Residential-Retail 3",
    ]


def test_best_k_takes_the_smallest_on_ties(spark):
    sweep = spark.createDataFrame([(2, 1.0, 0.4), (3, 1.0, 0.5), (4, 1.0, 0.5)], "k int, wcss double, silhouette double")
    assert clusters.best_k(sweep).first().k == 3


def feature_frame(spark, n=60):
    """Stations around five archetypes, and one with an undefined ratio."""
    centers = [
        (0.25, 0.2, 1.0, 0.05, 0.8, 1.2), (0.05, 0.1, 8.0, 0.45, 0.0, 0.9), (0.24, 0.1, 1.2, 0.06, -0.8, 1.1),
        (0.10, 0.1, 2.0, 0.08, 0.0, 0.2), (0.12, 0.3, 3.0, 0.1, 0.3, 2.2),
    ]
    points, labels = blobs(n, centers, 0.01, seed=4)
    rows = [(f"s{i:03d}", i + 1, *map(float, p)) for i, p in enumerate(points)]
    rows.append(("odd", n + 1, 0.0, 0.1, None, 0.2, 0.0, 1.0))
    kind = "station string, station_id long, " + ", ".join(f"{name} double" for name in fixed.FEATURES)
    return spark.createDataFrame(rows, kind), labels


def test_choose_k(spark):
    features, labels = feature_frame(spark)
    found = clusters.choose_k_and_cluster(features, (2, 7), starts=4)
    again = clusters.choose_k_and_cluster(features.repartition(5), (2, 7), starts=4)
    assert found.k == again.k == 5
    assert [r.station for r in found.rejects.collect()] == ["odd"]
    rows = found.labels.orderBy("station").collect()
    assert rows == again.labels.orderBy("station").collect()
    assert [r.station_id for r in rows] == list(range(1, 61))
    pairs = {(int(truth), r.cluster) for truth, r in zip(labels, rows)}
    assert len(pairs) == 5
    sweep = found.sweep.orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4, 5, 6, 7]
    assert [r.wcss for r in sweep] == sorted((r.wcss for r in sweep), reverse=True)
    names = {r.cluster: r.cluster_name for r in found.names.collect()}
    assert len(set(names.values())) == 5 and "Nightlife District" in names.values()
    means = found.features.join(found.labels, "station").groupBy("cluster").agg(F.avg("cv_hourly").alias("cv"))
    centroids = {r.cluster: r.cv_hourly for r in found.centroids.collect()}
    for row in means.collect():
        assert math.isclose(row.cv, centroids[row.cluster], abs_tol=1e-6)
    plane = clusters.project_2d(found.scaled)
    assert plane.count() == 60
    focus = dims.Focus({"s001": "One", "s002": "Two"})
    layers = charts.chart_k(found.features, found.labels, plane, focus).groupBy("layer").count().collect()
    assert {r.layer: r["count"] for r in layers} == {"background": 60, "focus": 2}
    hover = charts.chart_i(found.features, found.labels, plane, focus).where("station = 's001'").first()
    assert hover.annotation == "One" and hover.hover.startswith("One (s001) | Morning peak: 0.0")


def test_too_few_stations(spark):
    features, _ = feature_frame(spark, 6)
    with pytest.raises(ValueError, match="fewer distinct"):
        clusters.choose_k_and_cluster(features, (2, 8), starts=1)


def test_stages_and_bundles(spark, sf_dir, tmp_path):
    wide = inputs.hourly_wide(spark, sf_dir)
    focus = dims.Focus({"Stop1": "First stop", "Stop2": "Second stop"})
    stages = snapshots.build_stages(wide, focus, (2, 4), starts=2)
    assert [s.name for s in stages] == ["raw", "standardized", "normalized", "features", "clustered", "projected"]
    info = snapshots.snapshot_info(wide, "test", "2024-01-01T00:00:00Z")
    paths = snapshots.write_stages(stages, str(tmp_path), info)
    assert len(paths) == 13
    about = spark.read.json(paths[0]).first()
    assert about.generated_at == "2024-01-01T00:00:00Z" and about.source == "test" and about.n_months > 0
    first = spark.read.json(paths[1]).first()
    assert first.total_cols == "52" or first.total_cols == 52
    assert first.total_rows == wide.count()
    shape = {r.kind: r.n_columns for r in stages[0].payload.collect()}
    assert shape == {"ID columns": 3, "Hourly columns": 48, "Meta columns": 1}
    text = snapshots.stage_json(stages[1]).first().json
    assert set(json.loads(text)) == {"rank", "column_label", "cv", "distinctive"}


def test_job_from_tables_to_snapshots(spark, sf_dir, tmp_path):
    for name, df in (("hourly", inputs.hourly_wide(spark, sf_dir)), ("daily", inputs.daily_raw(spark, sf_dir)),
                     ("trades", inputs.trades_raw(spark, sf_dir))):
        df.write.parquet(str(tmp_path / name))
    argv = [x for name in ("hourly", "daily", "trades", "out") for x in (f"--{name}", str(tmp_path / name))]
    paths = job.main(spark, [*argv, "--focus", "Stop1=First stop", "--k", "2", "3", "--starts", "1"])
    assert len(paths) == 13 and all(spark.read.json(path).count() for path in paths)
    assert (tmp_path / "out/stages/price_index.parquet").exists()


def test_job_computes_once_and_writes_chart_tables(spark, sf_dir, tmp_path, monkeypatch):
    for name, df in (("hourly", inputs.hourly_wide(spark, sf_dir)), ("daily", inputs.daily_raw(spark, sf_dir)),
                     ("trades", inputs.trades_raw(spark, sf_dir))):
        df.write.parquet(str(tmp_path / name))
    argv = [x for name in ("hourly", "daily", "trades", "out") for x in (f"--{name}", str(tmp_path / name))]
    argv += ["--k", "2", "3", "--starts", "1", "--charts"]
    with pytest.raises(ValueError, match="two or more"):
        job.main(spark, [*argv, "--focus", "Stop1=First stop"])
    sweeps, melts = [], []
    sweep, melt = ridership.choose_k_and_cluster, ridership.hourly_long
    monkeypatch.setattr(ridership, "choose_k_and_cluster", lambda *a: sweeps.append(1) or sweep(*a))
    monkeypatch.setattr(ridership, "hourly_long", lambda *a: melts.append(1) or melt(*a))
    for name in ("choose_k_and_cluster", "hourly_long"):
        monkeypatch.setattr(snapshots, name, lambda *a: pytest.fail("computed a second time"))
    paths = job.main(spark, [*argv, "--focus", "Stop1=First stop", "--focus", "Stop2=Second stop"])
    assert sweeps == melts == [1]
    charted = {path.rsplit("/", 1)[1]: path for path in paths if "/charts/" in path}
    assert sorted(charted) == ["A", "B", "C", "D", "E", "F", "F_ks", "G", "I", "J", "K", "M", "N", "O"]
    long = spark.read.parquet(str(tmp_path / "out/stages/ridership_long.parquet"))
    focus = dims.Focus({"Stop1": "First stop", "Stop2": "Second stop"})
    assert spark.read.json(charted["B"]).count() == charts.chart_b(long, focus).count() == 48
    assert spark.read.json(charted["F_ks"]).count() == 1


def test_pipeline_writes_every_stage(spark, sf_dir, tmp_path):
    at, found = ridership.run(
        spark, inputs.hourly_wide(spark, sf_dir), inputs.daily_raw(spark, sf_dir),
        inputs.trades_raw(spark, sf_dir), str(tmp_path), (2, 4), starts=2,
    )
    labels = spark.read.parquet(at.cluster_labels)
    assert labels.columns == ["station", "station_id", "cluster", "cluster_name"]
    assert labels.count() + spark.read.parquet(at.rejects).count() == spark.read.parquet(at.features).count()
    assert spark.read.parquet(at.ridership_long).count() == 75 * 48
    assert spark.read.parquet(at.cluster_centroids).count() == found.k
    long, daily = spark.read.parquet(at.ridership_long), spark.read.parquet(at.daily)
    index, features = spark.read.parquet(at.price_index), spark.read.parquet(at.features)
    focus = dims.Focus({"Stop1": "First stop", "Stop2": "Second stop"})
    pair = dims.constant_table(spark, ["station_a", "station_b"], [("Stop1", "Stop2")])
    plane = clusters.project_2d(found.scaled)
    bundles = {
        **charts.section_4(long, daily, focus), **charts.section_5(long, daily, features, focus, pair),
        **charts.section_6(features, labels, found.centroids, found.names, plane, index, long, focus),
    }
    assert sorted(bundles) == ["A", "B", "C", "D", "E", "F", "F_ks", "G", "I", "J", "K", "M", "N", "O"]
    assert bundles["F_ks"].count() == 1 and bundles["B"].count() > 0 and bundles["O"].count() % 24 == 0


def _squared_by_hand(vectors, labels):
    """Silhouette by squared distances of each point, by the definition."""
    out = []
    for i, x in enumerate(vectors):
        gaps = {}
        for j, y in enumerate(vectors):
            if i != j and labels[i] is not None and labels[j] is not None:
                gaps.setdefault(labels[j], []).append(sum((p - q) ** 2 for p, q in zip(x, y)))
        others = [np.mean(v) for k, v in gaps.items() if k != labels[i]]
        if labels[i] is None:
            continue
        if not others:
            out.append((labels[i], None))
        elif labels[i] not in gaps:
            out.append((labels[i], 0.0))
        else:
            a, b = np.mean(gaps[labels[i]]), min(others)
            out.append((labels[i], (b - a) / max(a, b) if max(a, b) else 0.0))
    return out


def test_moments_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), np.full((5, 3), 9.0), [[1e6, 1e6, 1e6]]]) + 1e5
    labels = ["a"] * 40 + ["b"] * 28 + [None, None] + ["c"] * 5 + ["far"]
    rows = [(i, v.tolist(), x, "one") for i, (v, x) in enumerate(zip(vectors, labels))] + [(99, None, "a", "one")]
    points = spark.createDataFrame(rows, "id int, v array<double>, x string, same string").repartition(4)
    expected = {}
    for label, value in _squared_by_hand(vectors.tolist(), labels):
        expected.setdefault(label, []).append(value)
    found = {(r.assignment, r.cluster): r for r in silhouette.moments_silhouette(points, "v", ["x", "same"]).collect()}
    assert found["same", "one"].silhouette is None and found["same", "one"].n_points == len(vectors)
    for label, values in expected.items():
        assert found["x", label].n_points == len(values)
        assert found["x", label].silhouette == pytest.approx(np.mean(values), abs=1e-6)
    mean = {r.assignment: r for r in silhouette.mean_moments_silhouette(points, "v", ["x", "same"]).collect()}
    assert mean["x"].silhouette == pytest.approx(np.mean([v for x in expected.values() for v in x]), abs=1e-6) and mean["same"].silhouette is None
    assert silhouette.moments_silhouette(points.limit(0), "v", ["x"]).count() == 0


def test_candidates_stand_for_all_points_and_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    far = np.array([[0.0, 0.0], [50.0, 0.0], [0.0, 50.0], [50.0, 50.0]])
    rows = [(int(i), (far[i % 4] + rng.normal(0, 0.1, 2)).tolist()) for i in range(800)] + [(10_000 + i, [500.0, 500.0]) for i in range(400)]
    points = spark.createDataFrame(rows, "code long, point array<double>")
    one = kmeans.candidates(points.coalesce(1), 2, 5, 42)
    many = kmeans.candidates(points.repartition(7), 2, 5, 42)
    assert np.array_equal(one[0], many[0]) and np.array_equal(one[1], many[1])
    assert one[1].sum() == 1200 and len(np.unique(one[0], axis=0)) == len(one[0])
    best = kmeans.best_runs(points, 2, [4, 5], 3, 42)
    assert best[5].converged and best[5].cost < 800 * 0.1 and best[5].passes <= 3
    assert sorted(best[5].sizes.tolist()) == [200, 200, 200, 200, 400]


def test_candidates_of_few_distinct_points(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(90)]
    found, weights = kmeans.candidates(spark.createDataFrame(rows, "code long, point array<double>"), 2, 8, 1)
    assert found.tolist() == [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]] and weights.tolist() == [30, 30, 30]


def test_moments_score_chooses_k(spark, sf_dir):
    found = clusters.choose_k_and_cluster(inputs.features_by_user(spark, sf_dir), (2, 3), 2, 42, score="moments")
    assert found.k in (2, 3) and found.labels.count() == found.scaled.count()
