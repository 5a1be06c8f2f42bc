"""Empirical distributions of 24-hour profiles and the two-sample KS test."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tapflow.functions.numbers import ratio_or_zero
from tapflow.operators.reshape import hour_profile, slot_total, slots
from tapflow.operators.running import running_sums


def hour_samples(long: DataFrame) -> DataFrame:
    """One row per station with its sample: the 24 hourly shares, all 0 without taps."""
    profile = hour_profile(long, ["station"]).withColumn("total", slot_total())
    shares = F.transform(F.array(*slots()), lambda taps: ratio_or_zero(taps, F.col("total")))
    return profile.select("station", shares.alias("shares"))


def ecdf(samples: DataFrame) -> DataFrame:
    """Step points (share, cumulative) of each station's sample."""
    rows = samples.select(
        "station", F.size("shares").alias("n"), F.posexplode(F.array_sort("shares")).alias("place", "share")
    )
    step = F.col("place") + 1
    return rows.select("station", step.alias("step"), "share", (step / F.col("n")).alias("cumulative"))


def ks_exact_p(distance_steps: Column, n: Column) -> Column:
    """Two-sided exact p-value for two samples of size ``n`` whose distributions are at
    most ``distance_steps / n`` apart: 2 Σ (−1)^(j−1) C(2n, n − j·d) / C(2n, n)."""
    d = F.greatest(distance_steps.cast("long"), F.lit(1))
    # Each factor is built from the last. Terms fall as exp(-(j·d)² / n): beyond 6.5·√n they
    # are under 1e-18 of the first.
    last = F.least(n.cast("long"), F.greatest(d, F.ceil(F.sqrt(n.cast("double")) * 6.5)))
    size = "size"

    def step(state: Column, i: Column) -> Column:
        now = state[size] * (n - i + 1) / (n + i)
        sign = F.when(F.floor(i / d) % 2 == 1, 1.0).otherwise(-1.0)
        return F.struct(now.alias(size), (state["total"] + F.when(i % d == 0, sign * now).otherwise(0.0)).alias("total"))

    start = F.struct(F.lit(1.0).alias(size), F.lit(0.0).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1).cast("long"), last), start, step)["total"] * 2
    return F.when(distance_steps <= 0, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def ks_asymptotic_p(distance: Column, n_a: Column, n_b: Column) -> Column:
    """Limit p-value of λ = D·√(n_a·n_b / (n_a + n_b)).

    From λ = 1 on 2 Σ (−1)^(j−1) exp(−2 j² λ²); below, where that series converges too
    slowly, the same function as 1 − √(2π)/λ · Σ exp(−(2j−1)² π² / (8 λ²)).
    """
    squared = distance * distance * (n_a.cast("double") * n_b / (n_a + n_b))
    turns = F.sequence(F.lit(1), F.lit(20))
    series = F.aggregate(
        turns, F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(j * j * squared * -2.0),
    )
    odd = F.aggregate(
        turns, F.lit(0.0),
        lambda acc, j: acc + F.exp((j * 2 - 1) * (j * 2 - 1) * (-math.pi ** 2 / 8) / F.greatest(squared, F.lit(1e-12))),
    )
    small = 1 - math.sqrt(2 * math.pi) / F.sqrt(F.greatest(squared, F.lit(1e-12))) * odd
    value = F.when(squared < 1, small).otherwise(series)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def ks_distance(a: Column, b: Column) -> Column:
    """Struct of the largest gap between two samples' distributions and where it is.

    Distributions are compared as integer counts at the merged points (right-continuous),
    so ties are exact; the first point wins.
    """
    n_a, n_b = F.size(a), F.size(b)

    def at(x: Column) -> Column:
        count_a = F.size(F.filter(a, lambda value: value <= x))
        count_b = F.size(F.filter(b, lambda value: value <= x))
        return F.struct(
            F.abs(count_a * n_b - count_b * n_a).alias("gap"), (-x).alias("minus_x"),
            count_a.alias("count_a"), count_b.alias("count_b"),
        )

    return F.array_max(F.transform(F.array_distinct(F.concat(a, b)), at))


def ks_two_sample(samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """KS distance for each (station_a, station_b) pair, and where it is attained.

    A pair is one row with both small samples, so nothing is grouped. Each side is first
    reduced to the stations its pairs name: where one station meets all others, its side is
    one row, which Spark broadcasts by its size.
    """
    def of(side: str) -> DataFrame:
        key = f"station_{side}"
        named = samples.select(F.col("station").alias(key), F.col("shares").alias(f"shares_{side}"))
        return named.join(pairs.select(key).distinct(), key, "left_semi")

    both = pairs.select("station_a", "station_b").join(of("a"), "station_a").join(of("b"), "station_b")
    found = both.select(
        "station_a", "station_b", F.size("shares_a").alias("n_a"), F.size("shares_b").alias("n_b"),
        ks_distance(F.col("shares_a"), F.col("shares_b")).alias("at"),
    )
    return found.select(
        "station_a", "station_b",
        (F.col("at.gap") / (F.col("n_a") * F.col("n_b"))).alias("ks"),
        (-F.col("at.minus_x")).alias("at_share"),
        (F.col("at.count_a") / F.col("n_a")).alias("cdf_a"),
        (F.col("at.count_b") / F.col("n_b")).alias("cdf_b"),
        F.col("at.gap").alias("gap"), "n_a", "n_b",
    )


def ks_large(samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """As ``ks_two_sample`` for samples of any size in long form (station, value).

    Equal values of a sample are counted first. The merged values of a pair are range-sorted
    and both counts run up to each value, with offsets for earlier ranges; the largest gap of
    whole numbers wins, the first value on ties. No sample is ever in one row or one task.
    Missing and NaN values are left out; a pair with an empty sample has no row; a station's
    values are repeated for each pair that names it.
    """
    usable = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")) & F.col("station").isNotNull()
    counted = samples.where(usable).groupBy("station", "value").agg(F.count("*").alias("n"))
    named = pairs.select("station_a", "station_b").distinct()

    def of(side: str) -> DataFrame:
        both = named.join(counted.withColumnRenamed("station", f"station_{side}"), f"station_{side}")
        return both.select(
            "station_a", "station_b", "value", *[(F.col("n") if x == side else F.lit(0).cast("long")).alias(f"in_{x}") for x in "ab"]
        )

    keys = ["station_a", "station_b"]
    merged = of("a").unionByName(of("b")).groupBy(*keys, "value").agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    running = running_sums(merged, keys, ["value"], ["in_a", "in_b"])
    sizes = running.groupBy(*keys).agg(F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b")).where("n_a > 0 AND n_b > 0")
    wide = {x: F.col(x).cast("decimal(19,0)") for x in ("upto_in_a", "upto_in_b", "n_a", "n_b")}
    gap = F.abs(wide["upto_in_a"] * wide["n_b"] - wide["upto_in_b"] * wide["n_a"]).cast("decimal(38,0)")
    at = F.struct(gap.alias("gap"), (-F.col("value")).alias("minus_value"), "upto_in_a", "upto_in_b")
    best = running.join(sizes, keys).groupBy(*keys, "n_a", "n_b").agg(F.max(at).alias("at"))
    return best.select(
        *keys, (F.col("at.gap").cast("double") / F.col("n_a") / F.col("n_b")).alias("ks"), (-F.col("at.minus_value")).alias("at_share"),
        (F.col("at.upto_in_a") / F.col("n_a")).alias("cdf_a"), (F.col("at.upto_in_b") / F.col("n_b")).alias("cdf_b"),
        F.col("at.gap").alias("gap"), "n_a", "n_b",
    )


def ks_p_values(results: DataFrame) -> DataFrame:
    """Add the limit p-value, and the exact one where both samples are equally large."""
    equal = F.col("n_a") == F.col("n_b")
    steps = F.expr("CAST(gap DIV n_a AS BIGINT)")
    return results.withColumns({
        "p_exact": F.when(equal, ks_exact_p(steps, F.col("n_a"))),
        "p_limit": ks_asymptotic_p(F.col("ks"), F.col("n_a"), F.col("n_b")),
    })
