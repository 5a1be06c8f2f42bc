"""Landed pages: planned from names, bad pages as rows, files of other months left shut."""

import json
import os

from pyspark.sql import functions as F

from tapflow import fixed
from tapflow.schemas import HOURLY_WIDE
from tapflow.sources import landed

ROW = "name string, n string"


def page(rows, code=fixed.PAGE_OK, total=None):
    return json.dumps({fixed.PAGE_ENVELOPE: {"list_total_count": len(rows) if total is None else total, "RESULT": {"CODE": code, "MESSAGE": "m"}, "row": rows}}, ensure_ascii=False)


def land(spark, folder, pages):
    frame = spark.createDataFrame(pages, landed.PAGE).repartition(3)
    landed.land_pages(frame, folder)


PAGES = [
    ("202401", 1, 2, page([{"name": "가", "n": "1"}, {"name": None, "n": "x"}])),
    ("202401", 3, 4, page([], "ERROR-300")),
    ("202402", 1, 2, page([{"name": "b", "n": "2", "more": "left out"}])),
    ("202402", 3, 4, page([{"name": "c"}])[:30]),
    ("202403", 1, 2, "[]"),
    ("202403", 3, 4, None),
    ("202403", 5, 6, json.dumps({fixed.PAGE_ENVELOPE: {}})),
]


def test_good_and_bad_pages_are_rows(spark, tmp_path):
    folder = str(tmp_path / "pages")
    land(spark, folder, PAGES)
    rows = {(r.month, r.start_row): r for r in landed.read_landed(spark, folder).collect()}
    assert {k: (r.code, r.total, r.n_records) for k, r in rows.items()} == {
        ("202401", 1): (fixed.PAGE_OK, 2, 2), ("202401", 3): ("ERROR-300", 0, 0), ("202402", 1): (fixed.PAGE_OK, 1, 1),
        ("202402", 3): (landed.UNREADABLE, 0, 0), ("202403", 1): (landed.UNREADABLE, 0, 0), ("202403", 3): (landed.UNREADABLE, 0, 0),
        ("202403", 5): (fixed.PAGE_UNKNOWN, 0, 0),
    }
    records = landed.landed_records(landed.read_landed(spark, folder), ROW)
    assert sorted(map(tuple, records.collect()), key=repr) == [("202401", "가", "1"), ("202401", None, "x"), ("202402", "b", "2")]
    wide = landed.landed_records(landed.read_landed(spark, folder))
    assert wide.columns == ["month", *HOURLY_WIDE.names] and wide.count() == 3
    assert landed.read_landed(spark, folder, codes=["ERROR-300", landed.UNREADABLE]).count() == 4


def test_other_months_are_not_opened(spark, tmp_path):
    folder = str(tmp_path / "pages")
    land(spark, folder, PAGES)
    for month in ("202401", "202403"):
        for name in os.listdir(f"{folder}/{month}"):
            os.remove(f"{folder}/{month}/{name}")
    assert landed.read_landed(spark, folder, "202402", "202402").count() == 2
    reader = landed.LandedReader({"path": folder, "first_month": "202402", "last_month": "202402", "task_bytes": "1"})
    assert [[f[1:] for f in x.files] for x in reader.partitions()] == [[("202402", 1, 2)], [("202402", 3, 4)]]
    assert landed.LandedReader({"path": folder, "first_month": "2025"}).partitions() == [landed.Pages([])]
    assert landed.read_landed(spark, folder, "2025").count() == 0


def test_one_frame_used_with_two_filters(spark, tmp_path):
    folder = str(tmp_path / "pages")
    land(spark, folder, PAGES)
    found = landed.read_landed(spark, folder)
    both = found.where("month = '202401'").unionByName(found.where("month = '202402' AND code = 'INFO-000'"))
    assert sorted(r.month for r in both.collect()) == ["202401", "202401", "202402"]


def test_files_of_lost_tasks_and_foreign_folders(spark, tmp_path):
    folder = str(tmp_path / "pages")
    land(spark, folder, PAGES[:1])
    (tmp_path / "pages/202401/3_4-99.json").write_text(page([{"name": "lost", "n": "0"}]))
    assert landed.read_landed(spark, folder).count() == 1
    foreign = tmp_path / "foreign/202312"
    foreign.mkdir(parents=True)
    (foreign / "1_1000.json").write_text(page([{"name": "z", "n": "9"}]))
    (foreign / "notes.txt").write_text("no page")
    assert [tuple(r) for r in landed.landed_records(landed.read_landed(spark, str(tmp_path / "foreign")), ROW).collect()] == [("202312", "z", "9")]


def test_no_pages(spark, tmp_path):
    land(spark, str(tmp_path / "none"), [])
    assert landed.read_landed(spark, str(tmp_path / "none")).count() == 0
    assert landed.read_landed(spark, str(tmp_path / "none")).agg(F.sum("total")).first()[0] is None
