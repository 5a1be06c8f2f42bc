"""A corpus from documents: quality rules, near-dedup, decontamination, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.llm.hilbert import hilbert_shards
from tapflow.llm.mixing import mixed_documents
from tapflow.llm.near_dups import near_duplicates
from tapflow.llm.rules import quality_rules
from tapflow.llm.store import small_batches, written
from tapflow.llm.tiling import contaminated

# SQL can't express the fitted and pseudorandom stages; tests compare them with brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest.

    Null and empty texts have no words and go. Rows without an id are judged but match no
    label; repeated rows are judged each. Without documents or labels the rest passes.
    """
    small_batches(spark)
    return quality_rules(docs, _table(spark, sf_dir, "labels"), carry=True)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component; rows without an id stay, as do all rows of
    a kept id."""
    small_batches(spark)
    others = near_duplicates(docs, part=75, whole=100, size=5).where("NOT kept").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles don't cover a benchmark item; rows without an id stay."""
    small_batches(spark)
    leaks = contaminated(docs, _table(spark, sf_dir, "benchmark"), shortest=5, covered=0.5).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weights 3, 1, 2 to 150 % of all words: a row per document and pass.

    A null source is a source of its own, the last one; texts without words take no part;
    ids may be missing; rows equal in all columns are drawn as rows of their own.
    """
    return mixed_documents(docs, weights=[3, 1, 2], share=1.5, most=2.0)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """40 shards along a Hilbert curve through source, language and length; every row stays,
    missing values are the first cell of their dimension."""
    tied = docs.withColumn("_text_hash", F.xxhash64("text"))
    return hilbert_shards(tied, ["source", "lang", "n_chars"], shards=40, ties=["doc_id", "_text_hash"]).drop("_text_hash")


STAGES = [
    ("quality_rules", keep_good),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("mixture", mix_sources),
    ("sharding", cut_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each is written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
