"""The whole pipeline as one job: landed tables in, stage tables and snapshots out.

    spark-submit run_ridership.py --hourly PATH --daily PATH --trades PATH --out PATH \\
        --focus "Station=Display name" [--charts] [--pages] [--source landed] [--k 2 8] [--starts 10] [--seed 42]

With --pages the hourly input is a folder of landed JSON pages, whose status is checked;
otherwise all inputs are Parquet in the raw schemas. Snapshots, and with --charts the tables
behind the charts, come from the written stage tables and the one clustering.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tapflow.dims import Focus, constant_table
from tapflow.operators.clusters import Clustering, project_2d
from tapflow.plans import chart_tables as charts, ridership, snapshots
from tapflow.schemas import HOURLY_LONG
from tapflow.sources.pages import checked_pages, page_records, read_pages
from tapflow.sources.tables import read_stage, write_snapshot


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for name in ("hourly", "daily", "trades", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--pages", action="store_true")
    parser.add_argument("--charts", action="store_true")
    parser.add_argument("--focus", action="append", default=[], metavar="STATION=NAME")
    parser.add_argument("--source", default="landed")
    parser.add_argument("--k", type=int, nargs=2, default=(2, 8), metavar=("FROM", "TO"))
    parser.add_argument("--starts", type=int, default=10)
    parser.add_argument("--seed", type=int, default=42)
    return parser.parse_args(argv)


def main(spark: SparkSession, argv: list[str] | None = None) -> list[str]:
    """Run it; returns the paths of the snapshots and chart tables. Stage tables are under OUT/stages."""
    asked = arguments(argv)
    out = asked.out.rstrip("/")
    if asked.pages:
        wide = page_records(checked_pages(read_pages(spark, asked.hourly)))
    else:
        wide = spark.read.parquet(asked.hourly)
    focus = Focus(dict(pair.split("=", 1) for pair in asked.focus))
    if asked.charts and len(focus.names) < 2:
        raise ValueError("charts compare focus stations: name two or more")
    at, found = ridership.run(
        spark, wide, spark.read.parquet(asked.daily), spark.read.parquet(asked.trades), f"{out}/stages", tuple(asked.k), asked.starts, asked.seed
    )
    long = read_stage(spark, at.ridership_long, HOURLY_LONG)
    stages = snapshots.described_stages(wide, long, read_stage(spark, at.station_ids), found, focus)
    paths = snapshots.write_stages(stages, f"{out}/snapshots", snapshots.snapshot_info(wide, asked.source))
    if asked.charts:
        paths += [write_snapshot(df, f"{out}/charts/{name}") for name, df in chart_sections(spark, at, found, focus).items()]
    return paths


def chart_sections(spark: SparkSession, at: ridership.StageTables, found: Clustering, focus: Focus) -> dict[str, DataFrame]:
    """Tables of all charts from written stage tables. The KS row is of the first two focus stations."""
    long, daily = read_stage(spark, at.ridership_long, HOURLY_LONG), read_stage(spark, at.daily)
    features, labels, index = (read_stage(spark, path) for path in (at.features, at.cluster_labels, at.price_index))
    focused = charts.focus_rows(long, focus)
    found_charts = charts.section_4(focused, daily, focus) | charts.section_5(
        focused, daily, features, focus, constant_table(spark, ["station_a", "station_b"], [tuple(focus.names)[:2]])
    )
    plane = project_2d(found.scaled)
    return found_charts | charts.section_6(features, labels, found.centroids, found.names, plane, index, long, focus)
