"""Landed JSON response pages: status, rows, page plan and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapflow import fixed
from tapflow.schemas import HOURLY_WIDE, page_schema


def read_pages(spark: SparkSession, path: str | list[str], row: T.StructType = HOURLY_WIDE,
               envelope: str = fixed.PAGE_ENVELOPE) -> DataFrame:
    """One row per landed page: file, status code and message, promised total, record array.

    A page is one file of at most 1000 records, so each file is parsed whole.
    """
    pages = spark.read.schema(page_schema(row, envelope)).json(path, multiLine=True)
    body = F.col(envelope)
    return pages.select(
        F.col("_metadata.file_path").alias("page_file"),
        F.coalesce(body["RESULT"]["CODE"], F.lit(fixed.PAGE_UNKNOWN)).alias("code"),
        F.coalesce(body["RESULT"]["MESSAGE"], F.lit("no message")).alias("message"),
        F.coalesce(body["list_total_count"], F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(body["row"], F.array().cast(T.ArrayType(row))).alias("records"),
    )


def good_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("code") == fixed.PAGE_OK)


def bad_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("code") != fixed.PAGE_OK).drop("records")


def checked_pages(pages: DataFrame) -> DataFrame:
    """The pages; any page with a bad status fails the job with its code and message."""
    complaint = F.concat_ws(" ", F.lit("page status"), "code", "message", "page_file")
    return pages.where(
        F.when(F.col("code") == fixed.PAGE_OK, True).otherwise(F.raise_error(complaint).cast("boolean"))
    )


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record, pages without records give none."""
    return pages.select(F.inline("records"))


def page_ranges(totals: DataFrame, total: str, page_rows: int = fixed.PAGE_ROWS) -> DataFrame:
    """Inclusive (start_row, end_row) requests that cover ``total``; at least one each."""
    last = F.greatest(F.col(total), F.lit(1)).cast("bigint")
    starts = F.sequence(F.lit(1).cast("bigint"), last, F.lit(page_rows).cast("bigint"))
    return totals.withColumn("start_row", F.explode(starts)).withColumn(
        "end_row", F.col("start_row") + F.lit(page_rows - 1)
    )


def page_completeness(pages: DataFrame, by: str, total: str, rows: str) -> DataFrame:
    """Promised total, landed rows and their agreement for each ``by`` value."""
    landed = pages.groupBy(by).agg(
        F.max(total).alias("expected_rows"), F.sum(rows).alias("landed_rows")
    )
    return landed.withColumn("complete", F.col("expected_rows") == F.col("landed_rows"))
