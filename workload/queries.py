"""One query per operator, each over its whole tables."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapflow import dims, fixed
from tapflow.functions.arrays import number_text
from tapflow.functions.numbers import millions
from tapflow.functions.text import canonical_name, column_label, signed_percent
from tapflow.operators import aggregates, clusters, distributions, features, kmeans, lookup, ordering
from tapflow.operators import prices, regions, reshape, running, scaling, silhouette, sketches, states
from tapflow.plans import chart_tables as charts, dictionary, incremental, snapshots
from tapflow.sources import landed, pages, tables
from tapflow.staging import checkpointed, new_folder
from workload import inputs
from workload.inputs import FOCUS, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Doubles at fixed digits, with no negative zero."""
    return df.withColumns({name: F.round(name, digits) + F.lit(0.0) for name in names})


def _with_text(df: DataFrame) -> DataFrame:
    """The change's text made of the rounded number, so that the last digit can't differ."""
    return df.withColumn("change_text", signed_percent(F.round("change", 6), 4))


# Sources and dimensions


@query
def page_ranges(spark, sf):
    """Page plan of each month's sale records."""
    month = F.date_format("l_shipdate", "yyyyMM").alias("month")
    totals = table(spark, sf, "lineitem").groupBy(month).agg(F.count("*").alias("total"))
    return pages.page_ranges(totals, "total")


@query
def page_completeness(spark, sf):
    """Orders as pages: the largest line number is promised, the lines have landed.

    An order without lines is promised one, so it is incomplete and not left out.
    """
    orders = table(spark, sf, "orders").select("o_orderkey")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").cast("bigint").alias("total"), F.count("*").alias("landed")
    )
    landed = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        "o_orderkey", F.coalesce("total", F.lit(1).cast("bigint")).alias("total"),
        F.coalesce("landed", F.lit(0).cast("bigint")).alias("landed"),
    )
    return pages.page_completeness(landed, "o_orderkey", "total", "landed")


@query
def union_tagged(spark, sf):
    """Sale and order records of different columns under one roof, tagged by source."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_returnflag").alias("flag")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority")
    )
    none = orders.where(F.col("order_key") < 0)
    tagged = tables.union_frames([
        tables.tag_rows(items, source="lineitem"), tables.tag_rows(orders, source="orders"),
        tables.tag_rows(none, source="none"),
    ])
    return tagged.groupBy("source", "flag", "priority").agg(
        F.count("*").alias("n_rows"), F.max("order_key").alias("max_key")
    )


@query
def parquet_round_trip(spark, sf):
    """Hour totals of a written and re-read daily partition table."""
    path = new_folder(spark, "tapflow-round-trip")
    long = inputs.taps_by_type(spark, sf)
    tables.write_stage(long, path, partition_by=["year_month"], sort_by=["station", "hour"])
    return aggregates.hour_totals(tables.read_stage(spark, path, long.schema))


@query
def month_spine(spark, sf):
    """The 24 months up to the last sale, with the number of sales in each."""
    items = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyyMM").alias("month"))
    end = items.agg(F.max("month").alias("end"))
    spine = dims.month_spine(end, F.col("end"), 24)
    sales = items.groupBy("month").agg(F.count("*").alias("sales"))
    return spine.join(sales, "month", "left").na.fill(0, ["sales"])


@query
def month_day_mix(spark, sf):
    """Weekdays and weekend days of each month with orders, and its orders per day."""
    by_month = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "MM").alias("month")).agg(
        F.count("*").alias("orders")
    )
    mixed = dims.with_day_mix(by_month, F.col("month"))
    return rounded(mixed.withColumn("orders_per_day", F.col("orders") / F.col("n_days")), 4, "orders_per_day")


@query
def region_dim(spark, sf):
    """Suppliers by region of the dimension, with focus flag and the focus station's hypothesis."""
    regions = dims.region_dimension(spark)
    focus = dims.focus_dimension(spark).select("gu", "full_name", "hypothesis")
    suppliers = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    placed = regions.join(suppliers, regions.region_no == suppliers.s_nationkey)
    return placed.join(focus, "gu", "left").select(
        "gu", "gu_code", "gu_en", "in_focus", "full_name", "hypothesis", "suppliers"
    )


@query
def hour_weekday_spines(spark, sf):
    """Events in each of the 168 cells of the week, empty cells 0."""
    counted = table(spark, sf, "events").groupBy(
        F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour")
    ).agg(F.count("*").alias("events"))
    cells = dims.week_grid(spark).join(counted, ["weekday", "hour"], "left").na.fill(0, ["events"])
    named = cells.join(dims.weekday_spine(spark), "weekday").join(dims.hour_spine(spark), "hour")
    return named.select("weekday", "weekday_name", "hour", "events")


# Normalise


@query
def hourly_long(spark, sf):
    return reshape.hourly_long(inputs.hourly_wide(spark, sf))


@query
def daily_clean(spark, sf):
    return inputs.daily(spark, sf)


@query
def trades_clean(spark, sf):
    return rounded(inputs.trades(spark, sf), 4, "price_per_m2")


@query
def trades_empty(spark, sf):
    """Cleaning no records keeps the whole schema."""
    raw = inputs.trades_raw(spark, sf).where(F.col(fixed.RAW_FLOOR) < 0)
    clean = reshape.trades_clean(raw)
    return clean.agg(
        F.count("*").alias("n_rows"), F.lit(len(clean.columns)).alias("n_columns"),
        F.max("dong").alias("dong"), F.max("deal_krw").alias("deal_krw"),
    )


@query
def canonical_names(spark, sf):
    """Part names with bracketed aliases and blanks, cleaned and counted."""
    key = F.col("p_partkey")
    messy = F.when(key % 3 == 0, F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).when(
        key % 3 == 1, F.concat(F.lit(" "), "p_name", F.lit("（"), "p_type", F.lit("） "))
    ).otherwise(F.col("p_name"))
    return table(spark, sf, "part").groupBy(canonical_name(messy).alias("name")).agg(
        F.count("*").alias("n_parts")
    )


@query
def direction_pivot(spark, sf):
    return reshape.direction_pivot(inputs.taps_by_user(spark, sf), ["station"])


@query
def dense_hours(spark, sf):
    profile = reshape.hour_profile(inputs.taps_by_user(spark, sf), ["station"])
    return reshape.dense_hours(profile, ["station"])


@query
def weekday_hour_matrix_wide(spark, sf):
    surface = aggregates.weekday_hour_surface(inputs.taps_by_type(spark, sf), inputs.daily(spark, sf))
    wide = reshape.weekday_hour_wide(surface)
    return rounded(wide, 6, *[f"{hour:02d}" for hour in fixed.HOURS])


@query
def column_labels(spark, sf):
    counted = inputs.taps_by_user(spark, sf).groupBy("hour", "direction").agg(F.sum("count").alias("taps"))
    return counted.select(column_label(F.col("hour"), F.col("direction")).alias("column_label"), "taps")


# Joins and sets


@query
def entity_ids(spark, sf):
    """Dense ids of users in name order, with their taps; ids join one row per user."""
    by_user = inputs.taps_by_user(spark, sf).groupBy("station").agg(
        F.count("*").alias("n_rows"), F.sum("count").alias("taps")
    )
    return lookup.assign_station_id(by_user)


@query
def attach_region(spark, sf):
    """Customers of each segment by attached nation and region; one region has no place."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    places = nations.where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").cast("string").alias("station"),
        (F.col("n_nationkey") + 0.5).cast("double").alias("lat"),
        (100.0 + F.col("n_nationkey")).cast("double").alias("lon"), F.col("r_name").alias("gu"),
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("station"), "c_mktsegment"
    )
    placed = lookup.attach_region(customers, places)
    return placed.groupBy("station", "lat", "lon", "gu", "c_mktsegment").agg(F.count("*").alias("customers"))


@query
def display_names(spark, sf):
    named = lookup.with_display_name(inputs.taps_by_type(spark, sf), FOCUS.table(spark))
    return named.groupBy("station", "display_name").agg(F.sum("count").alias("taps"))


@query
def focus_semi(spark, sf):
    """Taps of users that bought something above the mean value."""
    events = table(spark, sf, "events")
    mean = events.agg(F.avg("value")).scalar()
    focus = events.where((F.col("event_type") == "purchase") & (F.col("value") > mean)).select(
        F.col("user_id").cast("string").alias("station")
    ).distinct()
    by_user = inputs.taps_by_user(spark, sf).groupBy("station").agg(F.sum("count").alias("taps"))
    return lookup.keep_entities(by_user, focus)


@query
def focus_flags(spark, sf):
    focus = FOCUS.table(spark).select("station")
    flagged = lookup.flag_entities(inputs.taps_by_type(spark, sf), focus)
    return flagged.groupBy("station", "in_focus").agg(F.count("*").alias("n_rows"))


@query
def hypothesis_check(spark, sf):
    """Expected archetype of each user (by id) against the name of its given cluster."""
    labels = inputs.given_labels(spark, sf)
    names = F.array(*[F.lit(n) for n in (fixed.BUSINESS, fixed.NIGHTLIFE, "district mixed")])
    number = (F.col("station").cast("bigint") % 3).cast("int")
    focus = labels.select("station", F.element_at(names, number + 1).alias("hypothesis"))
    return lookup.check_hypotheses(labels, focus)


@query
def common_entities(spark, sf):
    """Customers with both an urgent and a low order."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("station"), "o_orderpriority")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    return lookup.common_entities(urgent, orders.where(F.col("o_orderpriority") == "5-LOW"))


@query
def distinct_union(spark, sf):
    """Distinct tap values of the first two focus stations together."""
    taps = inputs.taps_by_type(spark, sf).select("station", F.col("count").alias("value"))
    first, second = list(FOCUS.names)[:2]
    return lookup.distinct_union(
        taps.where(F.col("station") == first), taps.where(F.col("station") == second), "value"
    )


# Aggregates and windows


@query
def hour_totals(spark, sf):
    return aggregates.hour_totals(inputs.taps_by_user(spark, sf))


@query
def hour_direction_mean(spark, sf):
    return rounded(aggregates.hour_direction_mean(inputs.taps_by_user(spark, sf)), 6, "mean_count")


@query
def column_distinctiveness(spark, sf):
    return aggregates.column_distinctiveness(inputs.taps_by_user(spark, sf))


@query
def monthly_price_index(spark, sf):
    index = prices.monthly_price_index(inputs.trades(spark, sf))
    return rounded(index, 3, "median_price_per_m2")


@query
def weekday_mean(spark, sf):
    return rounded(aggregates.weekday_mean(inputs.daily(spark, sf)), 6, "mean_taps")


@query
def hour_share(spark, sf):
    return rounded(aggregates.hour_share(inputs.taps_by_user(spark, sf)), 9, "share")


@query
def weekday_hour_surface(spark, sf):
    surface = aggregates.weekday_hour_surface(inputs.taps_by_type(spark, sf), inputs.daily(spark, sf))
    return rounded(surface, 6, "value")


@query
def window_sums(spark, sf):
    return aggregates.window_sums(inputs.taps_by_user(spark, sf))


@query
def annual_totals(spark, sf):
    totals = aggregates.annual_totals(inputs.taps_by_priority(spark, sf))
    return rounded(totals.withColumn("taps_millions", millions(F.col("taps"))), 6, "taps_millions")


@query
def weekend_balance(spark, sf):
    balance = _with_text(aggregates.weekend_balance(inputs.daily(spark, sf)))
    return rounded(balance, 6, "weekday_mean", "weekend_mean", "change")


@query
def distinct_entities(spark, sf):
    long = inputs.taps_by_user(spark, sf)
    return long.agg(
        F.count_distinct("station").alias("n_stations"), F.count_distinct("line").alias("n_lines")
    )


@query
def extrema(spark, sf):
    surface = aggregates.weekday_hour_surface(inputs.taps_by_type(spark, sf), inputs.daily(spark, sf))
    limits = surface.agg(F.max("value").alias("max_value"), F.min("value").alias("min_value"))
    return rounded(limits, 6, "max_value", "min_value")


@query
def average_tie_rank(spark, sf):
    """Average-tie ranks, both ways, of the 24 hours by their number of users."""
    busy = aggregates.hour_totals(inputs.taps_by_user(spark, sf))
    by_hour = busy.groupBy("hour").agg(F.count("*").alias("busy_users"))
    return by_hour.select(
        "hour", "busy_users", ordering.average_rank("busy_users").alias("rank_down"),
        ordering.average_rank("busy_users", descending=False).alias("rank_up"),
    )


@query
def first_last(spark, sf):
    """First and last monthly order value of each priority."""
    series = inputs.taps_by_priority(spark, sf).groupBy("station", "year_month").agg(
        F.sum("count").alias("taps")
    )
    return ordering.first_last(series, "station", "year_month", "taps")


@query
def dedupe_names(spark, sf):
    """Nation regions as repeated names, numbered in nation order, with customers."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    named = ordering.dedupe_names(nations, "r_name", "n_nationkey", "unique_name")
    customers = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("customers")
    )
    return named.join(customers, "n_nationkey")


@query
def peak_hour(spark, sf):
    return ordering.peak_hour(aggregates.hour_totals(inputs.taps_by_user(spark, sf)))


@query
def peak_cell(spark, sf):
    surface = aggregates.weekday_hour_surface(inputs.taps_by_type(spark, sf), inputs.daily(spark, sf))
    return rounded(ordering.peak_cell(surface), 6, "peak_value")


@query
def top_columns(spark, sf):
    return ordering.top_columns(aggregates.column_distinctiveness(inputs.taps_by_user(spark, sf)))


@query
def preview_rows(spark, sf):
    return ordering.preview(inputs.daily(spark, sf), ["date", "line", "station"])


# Features and statistics


@query
def station_features(spark, sf):
    return rounded(inputs.features_by_user(spark, sf), 6, *fixed.FEATURES).orderBy("station")


@query
def station_features_with_id(spark, sf):
    """The flagship on a long table with ids, which it carries, in the long labelled form."""
    long = lookup.assign_station_id(inputs.taps_by_user(spark, sf))
    cells = features.feature_labels(features.station_features(long))
    return rounded(cells.select("station", "station_id", "feature_order", "label", "value"), 6, "value")


@query
def feature_rejects(spark, sf):
    """Users by whether all six features are defined."""
    return inputs.features_by_user(spark, sf).select("station", features.is_complete().alias("complete"))


@query
def ecdf(spark, sf):
    samples = distributions.hour_samples(inputs.taps_by_user(spark, sf))
    return rounded(distributions.ecdf(samples), 9, "share", "cumulative")


def _first_against_all(spark, sf) -> DataFrame:
    """KS rows of the first user and every other one; samples, one row per user, are kept."""
    samples = checkpointed(distributions.hour_samples(inputs.taps_by_user(spark, sf)))
    first = samples.agg(F.min("station")).scalar()
    pairs = samples.select(first.alias("station_a"), F.col("station").alias("station_b"))
    return distributions.ks_two_sample(samples, pairs.where("station_a <> station_b"))


@query
def ks_two_sample(spark, sf):
    """KS distance of the first user to every other user."""
    results = _first_against_all(spark, sf).drop("gap", "n_a", "n_b")
    return rounded(results, 9, "ks", "at_share", "cdf_a", "cdf_b")


@query
def ks_p_value(spark, sf):
    results = distributions.ks_p_values(_first_against_all(spark, sf))
    return rounded(results.select("station_a", "station_b", "ks", "p_exact", "p_limit"), 9,
                   "ks", "p_exact", "p_limit")


@query
def hourly_cv(spark, sf):
    return rounded(aggregates.hourly_cv(inputs.taps_by_user(spark, sf)), 6, "cv_hourly")


# Scaling and clusters


@query
def standardised(spark, sf):
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    scaler = scaling.fit_standard(complete, fixed.FEATURES)
    return rounded(scaler.transform(complete), 6, *fixed.FEATURES)


def _min_max(spark, sf, on_constant):
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    steady = complete.withColumn("steady", F.lit(7.0))
    columns = [*fixed.FEATURES, "steady"]
    return rounded(scaling.min_max(steady, columns, on_constant), 6, *columns)


@query
def min_max_keep(spark, sf):
    return _min_max(spark, sf, "keep")


@query
def min_max_zero(spark, sf):
    return _min_max(spark, sf, "zero")


@query
def min_max_eps(spark, sf):
    return _min_max(spark, sf, "eps")


@query
def wcss_given(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    return rounded(silhouette.wcss(embeddings, "embedding", "label"), 6, "wcss")


@query
def silhouette_given(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    points = silhouette.silhouette_points(embeddings, "vec_id", "embedding", ["label"])
    by_cluster = points.groupBy("cluster").agg(
        F.count("*").alias("n_points"), F.avg("silhouette").alias("silhouette")
    )
    return rounded(by_cluster, 6, "silhouette")


@query
def centroid_silhouette_given(spark, sf):
    """Linear silhouette of the given labels: distances to the labels' mean vectors."""
    points = table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("point"))
    cells = points.select("label", F.posexplode("point").alias("axis", "x"))
    means = cells.groupBy("label", "axis").agg(F.avg("x").alias("x")).groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("axis", "x"))), lambda cell: cell["x"]).alias("center")
    )
    centers = {row["label"]: row["center"] for row in means.collect()}  # one row per label
    return rounded(silhouette.centroid_silhouette(points, "point", {"label": centers}), 6, "silhouette")


@query
def moments_silhouette_given(spark, sf):
    """Squared-Euclidean silhouette of the given labels from cluster moments."""
    found = silhouette.moments_silhouette(table(spark, sf, "embeddings"), "embedding", ["label"])
    return rounded(found.select("cluster", "n_points", "silhouette"), 6, "silhouette")


def _scaled_points(spark, sf):
    """Complete features, their scaler, and points with station and code."""
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    scaler = scaling.fit_standard(complete, fixed.FEATURES)
    points = scaler.transform(complete).select(
        "station", F.xxhash64("station").alias("code"), F.array(*fixed.FEATURES).alias("point")
    )
    return complete, scaler, checkpointed(points)


@query
def kmeans_from_given(spark, sf):
    """Three passes of k-means from the points of the first four users: sizes, centres, cost."""
    _, scaler, points = _scaled_points(spark, sf)
    first = points.orderBy("station").limit(4).collect()  # the stated starting centres
    run = kmeans.refined(points, [row["point"] for row in first], max_passes=3, tolerance=-1.0)
    rows = [(i, int(run.sizes[i]), float(run.cost), *map(float, run.centers[i])) for i in range(run.k)]
    kind = "cluster int, n_stations long, wcss double, " + ", ".join(f"{name} double" for name in fixed.FEATURES)
    return rounded(scaler.inverse(spark.createDataFrame(rows, kind)), 6, "wcss", *fixed.FEATURES)


@query
def best_k_given(spark, sf):
    """Best k of a given sweep: customers' mean order values stand for the scores of k = 2..8."""
    score = F.round(F.avg(F.col("o_totalprice").cast("double")), -3).alias("silhouette")
    sweep = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 7 + 2).cast("int").alias("k")).agg(score)
    return clusters.best_k(sweep)


@query
def inverse_scaled(spark, sf):
    """Means of standardised features by given cluster, taken back to the features' units."""
    complete, scaler, _ = _scaled_points(spark, sf)
    means = clusters.centroids_of(scaler.transform(complete), inputs.given_clusters(spark, sf))
    return rounded(scaler.inverse(means), 6, *fixed.FEATURES)


@query
def scaler_reuse(spark, sf):
    """Users with an odd number, standardised by the statistics of those with an even one."""
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    even = F.col("station").cast("bigint") % 2 == 0
    scaler = scaling.fit_standard(complete.where(even), fixed.FEATURES)
    return rounded(scaler.transform(complete.where(~even)), 6, *fixed.FEATURES)


@query
def kmeans_facts(spark, sf):
    """What must hold of the fitted clustering, as rows of fact and whether it does."""
    found = _clustering(spark, sf)
    centers = {row["cluster"]: [row[name] for name in fixed.FEATURES] for row in found.centroids_scaled.collect()}
    placed = found.scaled.join(found.labels.select("station", "cluster"), "station")
    apart = {number: sum(((F.col("point")[i] - x) * (F.col("point")[i] - x) for i, x in enumerate(center)), F.lit(0.0))
             for number, center in centers.items()}
    nearest = F.least(*apart.values()) if len(apart) > 1 else next(iter(apart.values()))
    own = F.coalesce(*[F.when(F.col("cluster") == number, gap) for number, gap in apart.items()])
    worst = F.max(own - nearest)
    means = found.features.join(found.labels.select("station", "cluster"), "station").groupBy("cluster").agg(
        *[F.avg(name).alias(f"mean_{name}") for name in fixed.FEATURES]
    ).join(found.centroids, "cluster")
    gap = F.max(F.greatest(*[F.abs(F.col(f"mean_{name}") - F.col(name)) for name in fixed.FEATURES]))
    sizes = found.labels.groupBy("cluster").count()
    ordered = F.min(F.col("previous") >= F.col("count"))
    previous = F.lag("count", 1, 1 << 62).over(Window.orderBy("cluster"))  # one row per cluster
    facts = [
        ("every label is the nearest centre", placed.agg((worst < 1e-9).alias("holds"))),
        ("every centre is the mean of its members", means.agg((gap < 1e-2).alias("holds"))),
        ("every complete station has a label", found.features.join(found.labels, "station", "left_anti").agg((F.count("*") == 0).alias("holds"))),
        ("clusters are numbered by falling size", sizes.withColumn("previous", previous).agg(ordered.alias("holds"))),
        ("cost falls with k", found.sweep.agg((F.max_by("wcss", "k") < F.min_by("wcss", "k")).alias("holds"))),
        ("the chosen k has the largest silhouette", found.sweep.agg((F.max_by("k", F.struct("silhouette", -F.col("k"))) == found.k).alias("holds"))),
        ("the chosen run settled", found.sweep.where(F.col("k") == found.k).agg(F.min("converged").alias("holds"))),
    ]
    rows = [frame.select(F.lit(name).alias("fact"), "holds") for name, frame in facts]
    return functools.reduce(DataFrame.union, rows)


@query
def projection_facts(spark, sf):
    """What must hold of the plane of the first two principal components."""
    _, _, points = _scaled_points(spark, sf)
    plane = clusters.project_2d(points.select("station", "point"))
    total = points.select(*[F.col("point")[i].alias(f"x{i}") for i in range(len(fixed.FEATURES))]).agg(
        sum((F.var_pop(f"x{i}") for i in range(len(fixed.FEATURES))), F.lit(0.0)).alias("total")
    )
    seen = plane.agg(
        F.count("*").alias("n"), F.var_pop("x").alias("x"), F.var_pop("y").alias("y"), F.covar_pop("x", "y").alias("xy")
    ).crossJoin(total).crossJoin(points.agg(F.count("*").alias("points")))  # one row each
    checks = {
        "every station has a place": F.col("n") == F.col("points"), "the axes are uncorrelated": F.abs("xy") < 1e-9,
        "the first axis varies most": F.col("x") >= F.col("y"),
        "the plane varies no more than the table": F.col("x") + F.col("y") <= F.col("total") + 1e-9,
        "the first axis takes its share": F.col("x") >= F.col("total") / len(fixed.FEATURES) - 1e-9,
    }
    return seen.select(F.inline(F.array(*[F.struct(F.lit(k).alias("fact"), v.alias("holds")) for k, v in checks.items()])))


@query
def archetype_given(spark, sf):
    return clusters.archetype_names(inputs.given_centroids(spark, sf))


def _clustering(spark, sf):
    return clusters.choose_k_and_cluster(inputs.features_by_user(spark, sf))


@query
def kmeans_sweep(spark, sf):
    """WCSS and silhouette of k = 2..8, and whether k is the chosen one."""
    found = _clustering(spark, sf)
    return found.sweep.withColumn("chosen", F.col("k") == F.lit(found.k))


@query
def cluster_labels(spark, sf):
    found = _clustering(spark, sf)
    return found.labels.join(F.broadcast(found.centroids), "cluster")


@query
def projection_2d(spark, sf):
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    scaled = scaling.fit_standard(complete, fixed.FEATURES).transform(complete)
    return clusters.project_2d(scaled.select("station", F.array(*fixed.FEATURES).alias("point")))


# Chart tables


@query
def chart_a(spark, sf):
    cells = charts.chart_a(inputs.taps_by_type(spark, sf), inputs.daily(spark, sf), FOCUS)
    return rounded(cells, 6, "value", "scale_max")


@query
def chart_b(spark, sf):
    return rounded(charts.chart_b(inputs.taps_by_type(spark, sf), FOCUS), 6, "share_pct", "peak_value")


PRIORITIES = dims.Focus({"1-URGENT": "Urgent", "3-MEDIUM": "Medium", "5-LOW": "Low"})


@query
def chart_c(spark, sf):
    return rounded(charts.chart_c(inputs.taps_by_priority(spark, sf), PRIORITIES), 6, "taps_millions")


@query
def chart_d(spark, sf):
    bars = _with_text(charts.chart_d(inputs.daily(spark, sf), FOCUS))
    return rounded(bars, 6, "weekday_mean", "weekend_mean", "change")


def _features_by_type(spark, sf):
    return features.station_features(inputs.taps_by_type(spark, sf))


def _ring_text(rows: DataFrame, digits: int) -> DataFrame:
    return rows.withColumns({
        "r": number_text(F.col("r"), digits), "theta": F.array_join("theta", ",")
    })


@query
def chart_e(spark, sf):
    return _ring_text(charts.chart_e(_features_by_type(spark, sf), FOCUS), 4)


@query
def chart_f(spark, sf):
    steps = charts.chart_f_steps(inputs.taps_by_type(spark, sf), FOCUS)
    return rounded(steps, 9, "share", "cumulative")


@query
def chart_f_ks(spark, sf):
    row = charts.chart_f_ks(inputs.taps_by_type(spark, sf), inputs.focus_pair(spark))
    numbers = ["ks", "at_share", "cdf_a", "cdf_b", "p_exact", "p_limit"]
    return rounded(row.select("station_a", "station_b", *numbers), 9, *numbers)


@query
def chart_g(spark, sf):
    return rounded(charts.chart_g(inputs.taps_by_type(spark, sf), FOCUS), 3,
                   "alight_thousands", "board_thousands")


USER_FOCUS = dims.Focus({"1": "User one", "2": "User two", "3": "User three"})


def _labelled_points(spark, sf):
    found = _clustering(spark, sf)
    return found.features, found.labels, clusters.project_2d(found.scaled)


@query
def chart_i(spark, sf):
    return charts.chart_i(*_labelled_points(spark, sf), USER_FOCUS)


def _given_points(spark, sf):
    """Features, labels under the fixed assignment, and two standardised features as plane."""
    complete, _ = features.complete_features(inputs.features_by_user(spark, sf))
    scaled = scaling.fit_standard(complete, fixed.FEATURES).transform(complete)
    plane = scaled.select(
        "station", F.col("evening_peak_intensity").alias("x"), F.col("late_night_share").alias("y")
    )
    return complete, inputs.given_labels(spark, sf), plane


@query
def chart_i_given(spark, sf):
    """Points, hover texts and annotations under the fixed assignment."""
    return rounded(charts.chart_i(*_given_points(spark, sf), USER_FOCUS), 6, "x", "y")


@query
def chart_k_given(spark, sf):
    """Background and focus layers under the fixed assignment."""
    return rounded(charts.chart_k(*_given_points(spark, sf), USER_FOCUS), 6, "x", "y")


@query
def snap_points_given(spark, sf):
    """Snapshot points under the fixed assignment."""
    _, labels, plane = _given_points(spark, sf)
    return rounded(snapshots.cluster_points(labels, plane, USER_FOCUS), 3, "x", "y")


@query
def chart_j(spark, sf):
    centroids = inputs.given_centroids(spark, sf)
    return _ring_text(charts.chart_j(centroids, clusters.archetype_names(centroids)), 4)


@query
def chart_k(spark, sf):
    return charts.chart_k(*_labelled_points(spark, sf), USER_FOCUS)


@query
def chart_m(spark, sf):
    index = prices.monthly_price_index(inputs.trades(spark, sf))
    rows = charts.chart_m(index, charts.price_region_labels(spark))
    return rounded(rounded(rows, 8, "price_millions"), 6, "change_pct")


@query
def chart_n(spark, sf):
    index = prices.monthly_price_index(inputs.trades(spark, sf))
    rows = charts.chart_n(index, charts.price_region_labels(spark))
    # Medians end in quarters of a KRW, so 8 digits of a million are exact and hold no ties.
    return rounded(rounded(rows, 8, "start_price", "end_price"), 6, "change_pct")


@query
def chart_o(spark, sf):
    return charts.chart_o(inputs.taps_by_user(spark, sf), inputs.given_labels(spark, sf))


@query
def cluster_hours(spark, sf):
    return aggregates.cluster_hours(inputs.taps_by_user(spark, sf), inputs.given_labels(spark, sf))


@query
def cluster_sizes(spark, sf):
    return aggregates.cluster_sizes(inputs.given_labels(spark, sf))


# Snapshots


@query
def snap_raw_shape(spark, sf):
    return snapshots.raw_shape(inputs.hourly_wide(spark, sf))


@query
def snap_columns(spark, sf):
    return snapshots.top_column_bars(aggregates.column_distinctiveness(inputs.taps_by_user(spark, sf)))


@query
def snap_flow(spark, sf):
    return snapshots.flow_lines(inputs.taps_by_type(spark, sf), FOCUS)


@query
def snap_profile(spark, sf):
    return _ring_text(snapshots.feature_profiles(_features_by_type(spark, sf), FOCUS), 3)


@query
def snap_clusters(spark, sf):
    return snapshots.cluster_bars(inputs.given_labels(spark, sf))


@query
def snap_points(spark, sf):
    _, labels, plane = _labelled_points(spark, sf)
    return snapshots.cluster_points(labels, plane, USER_FOCUS)


# Incremental stage tables


@functools.lru_cache(maxsize=4)
def _refreshed_states(spark, sf):
    """States after two loads: half of the newest month's rows are missing in the first."""
    long = inputs.taps_by_order(spark, sf)
    newest = F.lit(long.agg(F.max("year_month")).first()[0])
    path, folder = new_folder(spark, "tapflow-long"), new_folder(spark, "tapflow-states")
    first = long.where((F.col("year_month") != newest) | (F.col("hour") % 2 == 0))
    tables.write_stage(first, path, partition_by=["year_month"], sort_by=["station", "hour"])
    incremental.refresh(spark, path, folder)
    long.where(F.col("year_month") == newest).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month").parquet(path)
    incremental.refresh(spark, path, folder)
    return folder


@query
def incremental_hour_totals(spark, sf):
    """Taps by station and hour from monthly states, the newest month counted again."""
    return states.hour_totals_of(incremental.current_states(spark, _refreshed_states(spark, sf)))


@query
def incremental_hour_means(spark, sf):
    """Mean and deviation of counts by station, hour and direction from monthly states."""
    found = states.hour_direction_mean_of(incremental.current_states(spark, _refreshed_states(spark, sf)))
    return rounded(found, 3, "mean_count", "std_count")


@query
def incremental_annual_totals(spark, sf):
    """Taps by station and year from monthly states."""
    return states.annual_totals_of(incremental.current_states(spark, _refreshed_states(spark, sf)))


@query
def incremental_features(spark, sf):
    """The six features from monthly states instead of facts."""
    long = states.states_as_long(incremental.current_states(spark, _refreshed_states(spark, sf)))
    return rounded(features.station_features(long), 6, *fixed.FEATURES)


# Sketches


@functools.lru_cache(maxsize=4)
def _stored_sketches(spark, sf):
    path = new_folder(spark, "tapflow-sketches")
    tables.write_stage(sketches.price_sketches(inputs.trades(spark, sf)), path, partition_by=["year_month"])
    return path


@query
def approximate_price_index(spark, sf):
    """Median price by region and month from stored sketches; exact up to 2048 sales a month."""
    found = sketches.approximate_prices(tables.read_stage(spark, _stored_sketches(spark, sf)))
    return rounded(found.select("gu_code", "year_month", "n_sales", "median_price_per_m2"), 3, "median_price_per_m2")


@query
def sketch_errors(spark, sf):
    """Sketches merged by region and year against all sales: whether the median's rank and the number
    of buildings are within three times their errors."""
    stored = tables.read_stage(spark, _stored_sketches(spark, sf)).withColumn("year", F.year("year_month"))
    guessed = sketches.approximate_prices(sketches.merged_sketches(stored, "gu_code", "year"))
    sales = inputs.trades(spark, sf).select("gu_code", F.year("contract_date").alias("year"), "price_per_m2", "complex")
    price, guess = F.col("price_per_m2"), F.col("median_price_per_m2")
    held = sales.join(guessed.select("gu_code", "year", "median_price_per_m2", "n_complexes"), ["gu_code", "year"]).groupBy("gu_code", "year").agg(
        F.count("*").alias("n_sales"), F.count_distinct("complex").alias("n_complexes"), F.max("n_complexes").alias("about"),
        (F.count_if(price < guess) / F.count("*")).alias("below"), (F.count_if(price <= guess) / F.count("*")).alias("upto"),
    )
    off = F.greatest(F.col("below") - 0.5, F.lit(0.5) - F.col("upto"), F.lit(0.0))
    return held.select(
        "gu_code", "year", "n_sales", "n_complexes", (off <= 3 * sketches.rank_error()).alias("median_within"),
        (F.abs(F.col("about") - F.col("n_complexes")) <= 3 * sketches.distinct_error() * F.col("n_complexes")).alias("distinct_within"),
    )


# Orders over whole tables


@query
def ks_large(spark, sf):
    """KS of the prices of all sales between return flags, by running counts over ranges."""
    sales = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("station"), F.col("l_extendedprice").cast("double").alias("value"))
    flags = sales.select("station").distinct()
    pairs = flags.withColumnRenamed("station", "station_a").join(flags.withColumnRenamed("station", "station_b"), F.expr("station_a < station_b"))
    found = distributions.ks_large(sales, pairs)
    p_limit = distributions.ks_asymptotic_p(F.col("ks"), F.col("n_a"), F.col("n_b"))
    return rounded(found.withColumn("p_limit", p_limit).drop("gap"), 9, "ks", "cdf_a", "cdf_b", "p_limit")


@query
def average_rank_of_taps(spark, sf):
    """Average-tie rank of every event's taps among all events and among those of its type."""
    events = table(spark, sf, "events").select("event_id", "event_type", F.floor("value").cast("bigint").alias("taps"))
    ranked = running.with_average_rank(events, "taps", "rank_down")
    return running.with_average_rank(ranked, "taps", "rank_up_in_type", ["event_type"], descending=False)


@query
def growing_ids(spark, sf):
    """Ids of users after two loads, the second with all of them."""
    folder = new_folder(spark, "tapflow-ids")
    long = inputs.taps_by_user(spark, sf)
    dictionary.extend_ids(long.where(F.col("station").cast("bigint") % 3 == 0), folder)
    dictionary.extend_ids(long, folder)
    return dictionary.stored_ids(spark, folder)


# Landed pages


@query
def landed_months(spark, sf):
    """Orders landed as pages of 100 rows, one page in seven with an error, one in eleven cut short;
    pages, their status and records by month from 1996 on."""
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderkey", "o_orderpriority", "o_totalprice")
    placed = orders.withColumn("place", F.row_number().over(Window.partitionBy("month").orderBy("o_orderkey")) - 1)
    sizes = orders.groupBy("month").agg(F.count("*").alias("list_total_count"))
    record = F.struct(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("string").alias("price"))
    page = (F.col("place") / 100).cast("long")
    grouped = placed.groupBy("month", page.alias("page")).agg(F.sort_array(F.collect_list(record)).alias("row")).join(sizes, "month")
    number = F.col("month").cast("long") + F.col("page")
    result = F.when(number % 7 == 0, F.struct(F.lit("ERROR-500").alias("CODE"), F.lit("lost").alias("MESSAGE"))).otherwise(
        F.struct(F.lit(fixed.PAGE_OK).alias("CODE"), F.lit("fine").alias("MESSAGE"))
    )
    body = F.to_json(F.struct(F.struct("list_total_count", result.alias("RESULT"), "row").alias(fixed.PAGE_ENVELOPE)))
    whole = F.when(number % 11 == 0, F.substring(body, 1, 40)).otherwise(body)
    path = new_folder(spark, "tapflow-landed")
    landed.land_pages(grouped.select("month", (F.col("page") * 100 + 1).alias("start_row"), (F.col("page") * 100 + 100).alias("end_row"), whole.alias("content")), path)

    found = landed.read_landed(spark, path, first_month="199601")
    about = found.groupBy("month").agg(
        F.count("*").alias("n_pages"), F.count_if(F.col("code") == "ERROR-500").alias("n_errors"),
        F.count_if(F.col("code") == landed.UNREADABLE).alias("n_unreadable"), F.max("total").alias("promised"),
        F.max("end_row").alias("last_row"),
    )
    records = landed.landed_records(found, "key string, priority string, price string").groupBy("month").agg(
        F.count("*").alias("landed"), F.sum(F.col("key").cast("long")).alias("keys"), F.max("priority").alias("priority")
    )
    return about.join(records, "month", "left").na.fill(0, ["landed"])


# JSON


@query
def json_round_trip(spark, sf):
    """The price index written as a JSON snapshot and read back."""
    path = new_folder(spark, "tapflow-json")
    index = rounded(prices.monthly_price_index(inputs.trades(spark, sf)), 3, "median_price_per_m2")
    tables.write_snapshot(index, path)
    return spark.read.schema("gu_code string, year_month string, median_price_per_m2 double").json(path)


@query
def json_lines(spark, sf):
    """Hour totals as one JSON text a row."""
    totals = aggregates.hour_totals(inputs.taps_by_type(spark, sf))
    stage = snapshots.Stage("hours", "Hours", "taps", totals, totals)
    return snapshots.stage_json(stage)


# Regions by area


def _polygons(spark, sf):
    """A star-shaped ring per nation: a corner per supplier, at equal angles, as far out as its balance says."""
    suppliers = table(spark, sf, "supplier")
    places = Window.partitionBy("s_nationkey")
    turn = 2 * math.pi * (F.row_number().over(places.orderBy("s_suppkey")) - 1) / F.count("*").over(places)
    out = 2 + F.pmod("s_suppkey", F.lit(7)) / 2
    middle_x, middle_y = F.col("s_nationkey") % 5 * 8, F.floor(F.col("s_nationkey") / 5) * 8
    corner = F.struct(turn.alias("turn"), F.round(middle_x + out * F.cos(turn), 6).alias("lon"), F.round(middle_y + out * F.sin(turn), 6).alias("lat"))
    corners = suppliers.select("s_nationkey", corner.alias("corner"))
    return corners.groupBy(F.col("s_nationkey").cast("string").alias("gu")).agg(
        F.transform(F.sort_array(F.collect_list("corner")), lambda c: F.struct(c["lon"].alias("lon"), c["lat"].alias("lat"))).alias("ring")
    )


@query
def regions_by_area(spark, sf):
    """Customers by the polygon that holds their place, by a grid of half units."""
    key = F.col("c_custkey")
    points = table(spark, sf, "customer").select(
        "c_custkey", (F.pmod(key * 7919, F.lit(4000)) / 100.0 - 4).alias("lon"), (F.pmod(key * 104729, F.lit(4000)) / 100.0 - 4).alias("lat")
    )
    return regions.attach_region_by_area(points, _polygons(spark, sf), 0.5)
