"""Stage tables: union, tagging, Parquet and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column that a frame lacks becomes NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def tag_rows(df: DataFrame, **tags: object) -> DataFrame:
    """Add constant or computed columns such as the query parameters."""
    return df.withColumns({
        name: tag if isinstance(tag, Column) else F.lit(tag) for name, tag in tags.items()
    })


def with_provenance(df: DataFrame, source: str) -> DataFrame:
    """Add the source name and the time of the run."""
    return tag_rows(df, source=source, fetched_at=F.current_timestamp())


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Write a stage table as Parquet.

    Rows are range-split on the partition and sort columns and, within equal ones, on a
    hash of the whole row: each task opens few folders, and a month, station or hour with
    a large part of the rows spreads over several tasks. Files are sorted by the columns.
    """
    partition_by, sort_by = partition_by or [], sort_by or []
    keys = partition_by + sort_by
    if keys:
        df = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def stamped_path(folder: str, name: str, stamp: str) -> str:
    """Folder of one raw pull, time-stamped so that pulls do not overwrite each other."""
    return f"{folder.rstrip('/')}/{name}_{stamp.replace(':', '-')}.parquet"


def read_stage(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Read a stage table; with a schema, partition columns keep their place in it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*schema.names) if schema is not None else df


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write rows as UTF-8 JSON lines."""
    df.write.mode("overwrite").json(path)
    return path
