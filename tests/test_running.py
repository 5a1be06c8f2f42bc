"""Running sums, ranks and KS over range partitions; ids that only grow."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.operators import distributions, running
from tapflow.plans import dictionary
from tapflow.sources import versions


def no_lone_window(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SinglePartition" not in plan


def test_running_sums_across_ranges(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", i, rng.randrange(100)) for i in range(3000)] + [(None, -1, 5)]
    df = spark.createDataFrame(rows, "g string, at long, x long").repartition(5)
    found = {(r.g, r.at): r.upto_x for r in running.running_sums(df, ["g"], ["at"], ["x"]).collect()}
    total, expected = {}, {}
    for g, at, x in sorted(r for r in rows if r[0]):
        total[g] = total.get(g, 0) + x
        expected[g, at] = total[g]
    assert found == expected
    whole = running.running_sums(df.where("g = 'hot'"), [], ["at"], ["x"])
    assert [r.upto_x for r in whole.orderBy("at").collect()] == np.cumsum([x for g, _, x in rows if g == "hot"]).tolist()
    assert running.running_sums(df.limit(0), ["g"], ["at"], ["x"]).count() == 0


def test_average_ranks_with_hot_ties_and_missing_values(spark):
    rng = random.Random(2)
    values = [7.0] * 700 + [float(rng.randrange(50)) for _ in range(900)] + [None, float("nan")]
    df = spark.createDataFrame([(i, rng.choice("ab"), v) for i, v in enumerate(values)], "id long, g string, v double")
    rows = df.collect()
    found = {r.id: r.rank for r in running.with_average_rank(df, "v", "rank").collect()}
    known = [r for r in rows if r.v is not None and not math.isnan(r.v)]
    for r in rows:
        if r in known:
            above, same = sum(x.v > r.v for x in known), sum(x.v == r.v for x in known)
            assert found[r.id] == above + (same + 1) / 2
        else:
            assert found[r.id] is None
    by_group = {r.id: r.rank for r in running.with_average_rank(df, "v", "rank", ["g"], descending=False).collect()}
    for r in known[::37]:
        own = [x.v for x in known if x.g == r.g]
        assert by_group[r.id] == sum(x < r.v for x in own) + (sum(x == r.v for x in own) + 1) / 2
    assert no_lone_window(running.with_average_rank(df, "v", "rank", ["g"]))


def test_large_ks_equals_the_array_form(spark):
    rng = random.Random(3)
    samples = {s: [round(rng.random() ** p, 2) for _ in range(24)] for s, p in (("a", 1), ("b", 2), ("c", 1.1), ("d", 1))} | {"e": [0.5] * 24}
    short = spark.createDataFrame(list(samples.items()), "station string, shares array<double>")
    pairs = spark.createDataFrame([("a", b) for b in "bcde"] + [("d", "e"), ("a", "missing")], "station_a string, station_b string")
    columns = ["station_a", "station_b", "ks", "at_share", "cdf_a", "cdf_b"]
    expected = sorted(map(tuple, distributions.ks_two_sample(short, pairs).select(*columns).collect()))
    long = short.select("station", F.explode("shares").alias("value")).unionByName(
        spark.createDataFrame([("a", None), ("b", float("nan")), (None, 1.0)], "station string, value double")
    )
    found = distributions.ks_large(long, pairs)
    for ours, theirs in zip(sorted(map(tuple, found.select(*columns).collect())), expected, strict=True):
        assert ours[:2] == theirs[:2] and ours[2:] == pytest.approx(theirs[2:], abs=1e-12)
    assert no_lone_window(found)


def test_large_ks_of_a_million_values(spark):
    n = 1_000_000
    values = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("station"),
        (F.pmod(F.xxhash64("id"), F.lit(100_003)) + F.when(F.col("id") % 2 == 0, 0).otherwise(2000)).cast("double").alias("value"),
    )
    pair = spark.createDataFrame([("a", "b")], "station_a string, station_b string")
    row = distributions.ks_large(values, pair).first()
    rows = values.toPandas()
    a, b = (np.sort(rows.value[rows.station == x].to_numpy()) for x in "ab")
    points = np.unique(rows.value)
    gaps = np.abs(np.searchsorted(a, points, "right") * len(b) - np.searchsorted(b, points, "right") * len(a))
    assert (row.n_a, row.n_b, int(row.gap)) == (len(a), len(b), int(gaps.max())) and row.at_share == points[gaps.argmax()]
    assert row.ks == pytest.approx(gaps.max() / len(a) / len(b), abs=1e-15)


def test_exact_p_of_small_and_large_samples(spark):
    def by_hand(d, n):
        return min(1.0, max(0.0, 2 * sum((-1) ** (j - 1) * math.exp(2 * math.lgamma(n + 1) - math.lgamma(n - j * d + 1) - math.lgamma(n + j * d + 1)) for j in range(1, n // d + 1))))

    cases = [(d, 24) for d in range(1, 25)] + [(1, 1), (3, 100), (40, 100), (100, 100), (900, 200_000), (2500, 1_000_000), (300, 1_000_000)]
    df = spark.createDataFrame(cases, "d int, n int").select("d", "n", distributions.ks_exact_p(F.col("d"), F.col("n")).alias("p"))
    for row in df.collect():
        assert row.p == pytest.approx(by_hand(row.d, row.n), rel=1e-6, abs=1e-9)
    assert spark.range(1).select(distributions.ks_exact_p(F.lit(0), F.lit(5)).alias("p")).first().p == 1.0


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "station string")


def test_ids_never_move(spark, tmp_path):
    folder = str(tmp_path / "ids")
    assert dictionary.stored_ids(spark, folder).count() == 0
    assert dictionary.extend_ids(names(spark, "m", "c", "c", None), folder) == 1
    first = {r.station: r.station_id for r in dictionary.stored_ids(spark, folder).collect()}
    assert first == {"c": 1, "m": 2}
    assert dictionary.extend_ids(names(spark, "c", "m", None), folder) == 1, "nothing new, no version"
    assert dictionary.extend_ids(names(spark, *[f"x{i:03d}" for i in range(200)], "a", "c"), folder) == 2
    second = {r.station: (r.station_id, r.load) for r in dictionary.stored_ids(spark, folder).collect()}
    assert second["c"] == (1, 1) and second["m"] == (2, 1) and second["a"] == (3, 2)
    assert sorted(x for x, _ in second.values()) == list(range(1, 204))
    assert {r.station for r in dictionary.stored_ids(spark, folder, 1).collect()} == {"c", "m"}


def test_loads_in_either_order_keep_their_ids(spark, tmp_path):
    loads = [names(spark, "b", "d"), names(spark, "a", "b", "c")]
    for turn in (loads, loads[::-1]):
        folder = str(tmp_path / f"ids{turn is loads}")
        dictionary.extend_ids(turn[0], folder)
        before = set(map(tuple, dictionary.stored_ids(spark, folder).collect()))
        dictionary.extend_ids(turn[1], folder)
        after = set(map(tuple, dictionary.stored_ids(spark, folder).collect()))
        assert before < after and sorted(x[1] for x in after) == [1, 2, 3, 4]


def test_a_load_that_broke_off_or_came_second_is_not_seen(spark, tmp_path):
    folder = str(tmp_path / "ids")
    dictionary.extend_ids(names(spark, "a"), folder)
    versions.write_version(spark.createDataFrame([("z", 9, 2)], dictionary.IDS), folder, 2)
    os.remove(f"{versions.path_of(folder, 2)}/_SUCCESS")
    assert dictionary.stored_ids(spark, folder).count() == 1
    assert dictionary.extend_ids(names(spark, "b"), folder) == 2
    assert sorted(r.station for r in dictionary.stored_ids(spark, folder).collect()) == ["a", "b"]
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        versions.write_version(names(spark, "c"), folder, 2)
