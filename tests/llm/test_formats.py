"""WARC round trips and chat perspectives."""

import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, StringStartsWith

from tapflow.llm import perspectives, warc
from tapflow.llm.oracles import ORACLES
from tapflow.llm.queries import QUERIES
from tapflow.staging import new_folder
from tests.compare import connect, differences
from tests.llm import cases

PAGES = "page_id long, url string, html string"


def expected_pages(rows, least=0):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least and page is not None:
            first[body] = max(first.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        leader = first.get(body)
        revisit = leader is not None and leader != page
        out.append((page, len(body), digest, "revisit" if revisit else "response", leader if revisit else None))
    return sorted(out, key=repr)


def test_pages_survive_the_archive(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "é", "\r\n\r\nWARC/1.1\r\n\r\n" * 3),
            (6, "u", cases.sentence(random.Random(1), 50_000)), (None, "u", "same"), (None, "u", "alone"), (7, "u", "é" * 4000)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("record_type", F.lit("clash"))
    for least in (0, 5):
        path = new_folder(spark, "warc-test")
        warc.write_warc(warc.page_records(pages, least), path, file_bytes=2000)
        assert sorted(map(tuple, warc.read_pages(spark, path).collect()), key=repr) == expected_pages(rows, least)
    full = warc.read_warc(spark, path).where("record_type = 'response'")
    assert {bytes(r.payload) for r in full.collect()} >= {x[2].encode() for x in rows if x[2]}


def test_empty_table_gives_an_empty_archive(spark):
    path = new_folder(spark, "warc-test")
    warc.write_warc(warc.page_records(spark.createDataFrame([], PAGES)), path)
    assert warc.read_warc(spark, path).count() == 0 and warc.read_pages(spark, path).count() == 0


def test_predicates_are_pushed_and_payloads_skipped(spark, tmp_path):
    path = new_folder(spark, "warc-test")
    pages = spark.range(50).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.repeat(F.lit("text "), 3000).alias("html"))
    warc.write_warc(warc.page_records(pages.where("page_id < 2").unionByName(pages.where("page_id >= 2").withColumn("html", F.concat("url", "html")))), path)
    df = warc.read_warc(spark, path, payload=False).where("record_type = 'revisit' OR target_uri = 'http://h/7'")
    assert df.count() == 2
    reader = warc.WarcReader({"path": path})
    asked = [EqualTo(("record_type",), "revisit"), StringStartsWith(("target_uri",), "http://h/"), EqualTo(("payload_bytes",), 3)]
    assert list(reader.pushFilters(asked)) == asked[2:] and reader.filters == asked[:2]
    assert warc.read_warc(spark, path).where("record_type = 'revisit' AND target_uri LIKE 'http://h/%'").count() == 1
    assert [r.payload for r in warc.read_warc(spark, path, payload=False).where("target_uri = 'http://h/7'").collect()] == [None]


def test_foreign_archives_are_read_in_order(spark, tmp_path):
    records = [warc.record({"record_id": f"<urn:x-page:{i}>", "record_type": "response", "target_uri": f"u{i}", "refers_to": None, "payload": b"p" * i}, "d") for i in range(1, 6)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "plain.warc").write_bytes(info + b"".join(records))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in [info, *records]))
    (tmp_path / "whole.warc.gz").write_bytes(gzip.compress(info + b"".join(records)))
    for name in ("plain.warc", "members.warc.gz", "whole.warc.gz"):
        df = warc.read_warc(spark, str(tmp_path / name))
        assert sorted((r.record_type, r.payload_bytes, bytes(r.payload)) for r in df.collect()) == sorted(
            [("warcinfo", 5, b"hello")] + [("response", i, b"p" * i) for i in range(1, 6)]
        )
        assert [r.target_uri for r in df.where("target_uri = 'u3'").collect()] == ["u3"]
    assert warc.read_warc(spark, str(tmp_path)).count() == 18


def test_base32_equals_the_standard_one(spark):
    for text in ("", "a", "longer text"):
        found = spark.range(1).select(warc.base32(F.unhex(F.sha1(F.lit(text)))).alias("x")).first()["x"]
        assert found == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_warc_query_on_the_given_pages(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op3_warc_pages"](spark, sf_dir).collect()), key=repr) == expected_pages(rows)


def test_perspectives_of_awkward_dialogues(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "first"),
            (2, 0, "system", "alone"), (None, 0, "ann", "lost"), (3, 0, "ann", "é🙂")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))
    found = {(r.conv_id, r.part, r.speaker): r for r in perspectives.rotated(turns, turns_per_part=4).collect()}
    assert set(found) == {(1, 0, s) for s in ("ann", "bob", "unknown")} | {(1, 1, s) for s in ("ann", "bob", "unknown")} | {(None, 0, "ann"), (3, 0, "ann")}
    ann = found[1, 0, "ann"]
    assert ann.text == "<|user name=unknown|>\nfirst\n<|end|>\n<|system|>\nrules\n<|end|>\n<|assistant|>\nhi\n<|end|>\n<|user name=bob|>\n\n<|end|>\n"
    assert [ann.text[m.start:m.end] for m in ann.mask] == ["hi\n<|end|>\n"]
    assert [found[3, 0, "ann"].text[m.start:m.end] for m in found[3, 0, "ann"].mask] == ["é🙂\n<|end|>\n"]
    assert [found[1, 1, "bob"].text[m.start:m.end] for m in found[1, 1, "bob"].mask] == ["\n<|end|>\n"] and not found[1, 1, "ann"].mask
    assert perspectives.rotated(turns.limit(0)).count() == 0


def test_long_dialogues_stay_whole(spark):
    rows = [(1, i, f"s{i % 3}", f"turn {i} é") for i in range(700)]
    found = perspectives.rotated(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    assert {(r.conv_id, r.part, r.speaker, r.n_turns) for r in found} == {(1, 0, f"s{k}", 700) for k in range(3)}
    for r in found:
        heads = ["<|assistant|>\n" if role == r.speaker else f"<|user name={role}|>\n" for _, _, role, _ in rows]
        assert r.text == "".join(h + text + "\n<|end|>\n" for h, (*_, text) in zip(heads, rows))
        assert [r.text[m.start:m.end] for m in r.mask] == [f"{text}\n<|end|>\n" for _, _, role, text in rows if role == r.speaker]


def test_queries_equal_their_sql(spark, sf_dir):
    connection = connect(sf_dir)
    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, sf_dir), sql, connection) == [], name
