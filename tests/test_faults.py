"""Hand-made cases of faults that were mended."""

import math

import pytest
from pyspark.sql import functions as F

from tapflow.operators.distributions import ks_asymptotic_p
from tapflow.operators.lookup import attach_region, with_display_name
from tapflow.plans.chart_tables import chart_n, chart_o, price_region_labels

LABELS = "gu_code string, year_month date, median_price_per_m2 double"


def test_limit_p_value_of_small_and_large_distances(spark):
    # known values of the limit distribution, and the textbook series where it converges
    cases = [(1e-6, 10 ** 6, 1.0), (0.0, 10, 1.0), (0.2, 50, None), (0.136, 200, None), (0.3, 50, None)]
    for distance, n, expected in cases:
        found = spark.range(1).select(ks_asymptotic_p(F.lit(distance), F.lit(n), F.lit(n)).alias("p")).first()["p"]
        squared = distance ** 2 * n / 2
        if expected is None:
            expected = sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * squared) for j in range(1, 200))
        assert found == pytest.approx(expected, abs=1e-9)


def test_change_of_a_zero_start_and_of_one_month(spark):
    rows = [("11110", "2024-01-01", 0.0), ("11110", "2024-02-01", 5.0), ("11140", "2024-01-01", 3.0),
            ("11170", "2024-01-01", 4.0), ("11170", "2024-02-01", 5.0)]
    index = spark.createDataFrame(rows, "gu_code string, m string, median_price_per_m2 double").select(
        "gu_code", F.to_date("m").alias("year_month"), "median_price_per_m2"
    )
    found = {r.gu_code: r.change_pct for r in chart_n(index, price_region_labels(spark)).collect()}
    assert found["11110"] is None and found["11140"] is None and found["11170"] == pytest.approx(25.0)


def test_doubled_lookup_keys_add_no_rows(spark):
    long = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "station string, n int")
    places = spark.createDataFrame(
        [("a", 1.0, 2.0, "x"), ("a", 1.0, 2.0, "y")], "station string, lat double, lon double, gu string"
    )
    names = spark.createDataFrame([("a", "One"), ("a", "Two")], "station string, en_name string")
    assert attach_region(long, places).count() == 3
    assert {r.display_name for r in with_display_name(long, names).collect()} == {"One", "b"}


def test_stack_holds_every_cluster(spark):
    long = spark.createDataFrame(
        [("s1", 8, "board", 5), ("s2", 8, "board", 7), ("s3", 8, "board", 1)],
        "station string, hour int, direction string, count long",
    )
    labels = spark.createDataFrame(
        [("s1", "Zone"), ("s2", "Business District"), ("s3", "Area")], "station string, cluster_name string"
    )
    rows = chart_o(long, labels).where("hour = 8").orderBy("stack_order").collect()
    assert [(r.cluster_name, r.stack_order, r.stack_top) for r in rows] == [
        ("Business District", 3, 7), ("Area", 5, 8), ("Zone", 6, 13),
    ]
