"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapflow.llm.store import written


def _nearest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, the node itself included."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """Root (smallest reachable node) of every node that has a link.

    ``edges`` has two columns of one ordered type; direction, repeats and loops don't matter.
    Result: node, root. Each round is two groupings and two joins on all links, written to
    the shared folder; hubs are pre-aggregated, and the joins are plain ones whose large
    partitions adaptive execution can split. Links with a null end are ignored.
    """
    a, b = edges.columns[:2]
    links = edges.select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    links = written(links, "links")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_nearest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())
