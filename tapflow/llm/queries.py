"""One registered query per operator, over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapflow.llm import best_position, block_dedup, byte_conv, hilbert, mixing, packed_ids, perspectives, prefix_trie, rules, suffix_dedup, tiling, warc
from tapflow.llm.near_dups import near_duplicates
from tapflow.staging import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_near_duplicates(spark, sf):
    """Near-duplicate components of all documents at a similarity of 75 of 100."""
    found = near_duplicates(table(spark, sf, "documents"), part=75, whole=100, size=5)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


@query
def op2_isolation_rules(spark, sf):
    """Rule statistics of all documents and the verdict of base rules and isolation forest."""
    found = rules.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly",
    )


@query
def op3_warc_pages(spark, sf):
    """All pages written as WARC records, equal payloads as revisits, and read back from the archives."""
    path = new_folder(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf, "pages"), least=0), path)
    return warc.read_pages(spark, path)


@query
def op4_string_tiling(spark, sf):
    """Every document with the benchmark items whose words its tiles cover to half or more."""
    return tiling.flagged(table(spark, sf, "documents"), table(spark, sf, "benchmark"), shortest=5, covered=0.5)


@query
def op5_perspectives(spark, sf):
    """Every conversation from the perspective of every participant."""
    found = perspectives.rotated(table(spark, sf, "conversations"))
    spans = F.transform("mask", lambda x: F.concat_ws("-", x["start"], x["end"]))
    return found.withColumn("mask", F.array_join(spans, ","))


@query
def op6_suffix_sort(spark, sf):
    """Bytes of all documents left after removing repeated strings of 100 bytes or more."""
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"), window=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_mixture(spark, sf):
    """Words taken of each document when sources are mixed by weights 3, 1, 2 to 150 % of all words."""
    return mixing.mixture_report(table(spark, sf, "documents"), weights=[3, 1, 2], share=1.5, most=2.0)


@query
def op8_hilbert_shards(spark, sf):
    """All documents in 40 shards along a Hilbert curve through source, language and size; the law is rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, sf, "documents").select(
        "doc_id", "source", "lang", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
    )
    placed = hilbert.hilbert_shards(narrow, ["source", "lang", "size"], shards=40, ties=["text_hash", "doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve_index",
    )


@query
def op9_block_anchors(spark, sf):
    """Words of all documents left after removing repeated passages of 20 words or more."""
    found = block_dedup.remove_repeats(table(spark, sf, "documents"), window=20, block=10)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query
def op10_byte_network(spark, sf):
    """Quality score of every document by a byte-level network learned from rows not held out."""
    return byte_conv.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op11_packed_ids(spark, sf):
    """Token ids of all documents in bit-packed files in the order of doc_id, read back from the files."""
    import public_tokenizers

    path = new_folder(spark, "ids")
    packed_ids.write_packed(table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed_ids.read_packed(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_best_position(spark, sf):
    """The 50 highest-scoring documents of every benchmark item among all documents."""
    return best_position.ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)


@query
def op13_prefix_trie(spark, sf):
    """Every node of the trie of rebuilt conversations with its counts."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"), group=20, heads=4)
