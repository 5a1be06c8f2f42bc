"""Written intermediate tables and sizes for planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.staging import new_folder


# Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python workers in batches of about ``BATCH_BYTES``.

    By default a batch has 10,000 rows or 64 MB, which the executor holds twice outside its heap
    for each task and worker. A limit that the session has set itself stays.
    """
    if _BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there: later steps cost no recompute
    when an executor is lost, and plans stay short."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total bytes of a text column."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """Number of partitions of about ``each`` bytes, at least one per shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


def hash_sample(df: DataFrame, keys: list[str], n: int, salt: int = 0) -> DataFrame:
    """At most ``n`` rows, those with the smallest hash of ``keys``.

    The hash is first cut at a share that leaves about half as many again, so what tasks
    hand on to the final choice does not grow with the number of tasks. Where repeated keys
    leave too few rows, the share is widened until there are enough.
    """
    total = df.count()
    share = min(1.0, (1.5 * n + 200) / max(total, 1))
    draw = F.xxhash64(*keys, F.lit(salt))
    while True:
        kept = df.where(draw <= F.lit(min(int(share * 2 ** 64), 2 ** 64 - 1) - 2 ** 63))
        if share >= 1 or kept.count() >= min(n, total):
            return kept.orderBy(draw, *keys).limit(n)
        share = min(1.0, share * 8)
