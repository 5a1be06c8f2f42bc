"""Landed pages, stage tables and snapshots on disk."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from tapflow.sources import pages, tables

ROW = T.StructType([T.StructField("사용월", T.StringType()), T.StructField("지하철역", T.StringType())])


def land(folder, name, body):
    (folder / name).write_text(json.dumps(body, ensure_ascii=False, indent=1), encoding="utf-8")


@pytest.fixture
def landed(tmp_path):
    rows = [{"사용월": "202401", "지하철역": f"역{i}"} for i in range(3)]
    ok = {"CODE": "INFO-000", "MESSAGE": "fine"}
    land(tmp_path, "1.json", {"CardSubwayTime": {"list_total_count": 4, "RESULT": ok, "row": rows}})
    land(tmp_path, "2.json", {"CardSubwayTime": {"list_total_count": 4, "RESULT": ok}})
    land(tmp_path, "3.json", {"CardSubwayTime": {"RESULT": {"CODE": "ERROR-500", "MESSAGE": "busy"}}})
    land(tmp_path, "4.json", {"other": 1})
    return str(tmp_path)


def test_pages(spark, landed):
    read = pages.read_pages(spark, landed, ROW)
    assert {row.page_file.rsplit("/", 1)[1]: row.code for row in read.collect()} == {
        "1.json": "INFO-000", "2.json": "INFO-000", "3.json": "ERROR-500", "4.json": "UNKNOWN",
    }
    bad = {row.code: row.message for row in pages.bad_pages(read).collect()}
    assert bad == {"ERROR-500": "busy", "UNKNOWN": "no message"}
    records = pages.page_records(pages.good_pages(read))
    assert sorted(map(tuple, records.collect())) == [("202401", f"역{i}") for i in range(3)]
    with pytest.raises(Exception, match="page status"):
        pages.checked_pages(read).count()
    assert pages.checked_pages(read.where(F.col("total") > 0)).count() == 2


def test_completeness(spark, landed):
    read = pages.good_pages(pages.read_pages(spark, landed, ROW))
    counted = read.select(F.lit("202401").alias("month"), "total", F.size("records").alias("landed"))
    row = pages.page_completeness(counted, "month", "total", "landed").first()
    assert (row.expected_rows, row.landed_rows, row.complete) == (4, 3, False)


def test_page_ranges(spark):
    totals = spark.createDataFrame([("a", 0), ("b", 1000), ("c", 2001)], "month string, total long")
    found = pages.page_ranges(totals, "total").orderBy("month", "start_row").collect()
    assert [(row.month, row.start_row, row.end_row) for row in found] == [
        ("a", 1, 1000), ("b", 1, 1000), ("c", 1, 1000), ("c", 1001, 2000), ("c", 2001, 3000),
    ]


def test_stage_round_trip(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id"), (F.col("id") % 3).cast("string").alias("month"), F.lit("역").alias("name")
    )
    path = tables.write_stage(df, str(tmp_path / "t"), partition_by=["month"], sort_by=["id"])
    again = tables.read_stage(spark, path, df.schema)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))
    assert len(list((tmp_path / "t").glob("month=*"))) == 3
    plan = again.where("month = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(40_000).select(F.lit("202401").alias("month"), F.col("id"))
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_stage(df, str(tmp_path / "hot"), partition_by=["month"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    assert len(list((tmp_path / "hot" / "month=202401").glob("*.parquet"))) > 4


def test_tags_and_stamp(spark):
    tagged = tables.with_provenance(tables.tag_rows(spark.range(1), 법정동코드="11680", 조회년월="202401"), "landed")
    row = tagged.first()
    assert (row["법정동코드"], row["조회년월"], row["source"]) == ("11680", "202401", "landed")
    assert row["fetched_at"] is not None
    assert tables.stamped_path("/raw/", "hourly", "2024-01-01T10:20:30") == "/raw/hourly_2024-01-01T10-20-30.parquet"


def test_json_snapshot(spark, tmp_path):
    path = tables.write_snapshot(spark.createDataFrame([("강남", [1.5, 2.0])], "s string, v array<double>"),
                                 str(tmp_path / "s"))
    lines = [line for part in (tmp_path / "s").glob("part-*") for line in part.read_text("utf-8").splitlines()]
    assert path and [json.loads(line) for line in lines] == [{"s": "강남", "v": [1.5, 2.0]}]
    assert "강남" in lines[0]
