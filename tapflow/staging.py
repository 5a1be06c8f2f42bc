"""Reliable materialisation of small intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def remove_at_end(spark: SparkSession, path: str) -> str:
    """Have Spark's JVM delete ``path`` when it ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where it is unset, a local session gets a folder of its own, deleted when it ends;
    on a cluster the job stops instead, as executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = remove_at_end(spark, tempfile.mkdtemp(prefix="tapflow-"))
    return _OWN[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that does not exist yet, deleted when the session ends."""
    return remove_at_end(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder and read on from there.

    The files outlive executors, so a lost executor costs no rescan of the facts.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
        remove_at_end(df.sparkSession, context.getCheckpointDir())
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read on from there.

    Like a checkpoint, but Spark knows the size of what it reads.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
