"""Fixed-width packing of token ids: round trips, random access, the query."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapflow.llm import packed_ids
from tapflow.llm.queries import QUERIES
from tapflow.staging import new_folder
from tests.llm import cases

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def encoded(texts):
    whole = Tokenizer.from_file(TOKENIZER)
    whole.encode_special_tokens = True
    return [x.ids + [2] for x in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 24, 31, 32])
def test_packing_takes_the_bits_asked_for(bits):
    rng = random.Random(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.array([rng.randrange(1 << bits) for _ in range(n)] if n else [], np.uint32)
        content = packed_ids.pack(ids, bits)
        assert len(content) == -(-n * bits // 8)
        assert packed_ids.unpack(content, bits, n).tolist() == ids.tolist()
        number = int.from_bytes(content, "little")
        assert [(number >> (bits * i)) & ((1 << bits) - 1) for i in range(n)] == ids.tolist()


def test_awkward_texts_survive_the_files(spark):
    texts = cases.awkward_texts() + ["<|endoftext|> it's 5'LL a\x1fb c\x85d e f ﬁ ＡΣΣ. é ́x", "n" * 5000, "don't, stop... now!?"]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumns({"start": F.lit("clash"), "ids": F.lit(1)})
    path = new_folder(spark, "ids-test")
    packed_ids.write_packed(docs.repartition(5), path, TOKENIZER, 2, part_bytes=20_000, block_ids=64, file_bytes=3000)
    rows = sorted(map(tuple, packed_ids.read_packed(spark, path).collect()))
    in_order = [t for _, t in sorted(zip(ids, texts))]
    start = 0
    for row, (doc_id, own) in zip(rows, enumerate(encoded(in_order))):
        assert row[:3] == (doc_id, start, len(own)) and np.frombuffer(row[3], "<u4").tolist() == own
        start += len(own)
    assert len(rows) == len(texts)
    info = packed_ids.manifest(path)
    assert info["bits"] == 16 and info["ids"] == start and len(info["files"]) > 3
    everything = [i for own in encoded(in_order) for i in own]
    rng = random.Random(3)
    for a, b in [(0, start), (0, 0), (start, start + 5), (63, 65), *((rng.randrange(start), rng.randrange(start)) for _ in range(30))]:
        assert packed_ids.ids_between(path, a, b).tolist() == everything[a:b]


def test_random_access_reads_only_the_blocks_asked_for(spark, tmp_path):
    path = new_folder(spark, "ids-test")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words of text "), 50).alias("text"))
    packed_ids.write_packed(docs, path, TOKENIZER, 2, block_ids=1024)
    system, folder = packed_ids.place(path)
    name = packed_ids.manifest(path)["files"][0]["name"]

    class Counting:
        def __init__(self, file):
            self.file, self.read = file, 0

        def size(self):
            return self.file.size()

        def read_at(self, n, at):
            self.read += n
            return self.file.read_at(n, at)

    with system.open_input_file(f"{folder}/{name}") as source:
        counting = Counting(source)
        assert len(packed_ids.PackedFile(counting).ids(5000, 5010)) == 10
        assert counting.read < 2 * 1024 * 2 + 100 < counting.size()


def test_repeated_and_missing_ids_and_empty_tables(spark):
    rows = [(None, "no id"), (3, "b b"), (3, "a"), (3, "a"), (1, None), (None, None), (-5, "first")]
    path = new_folder(spark, "ids-test")
    packed_ids.write_packed(spark.createDataFrame(rows, "doc_id long, text string"), path, TOKENIZER, 2)
    found = packed_ids.read_packed(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, -5, 1, 3, 3, 3]
    assert [r.start for r in found] == np.concatenate([[0], np.cumsum([r.n_tokens for r in found])[:-1]]).tolist()
    assert sorted(tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in found) == sorted(map(tuple, encoded(t for _, t in rows)))
    empty = new_folder(spark, "ids-test")
    packed_ids.write_packed(spark.createDataFrame([], "doc_id long, text string"), empty, TOKENIZER, 2)
    assert packed_ids.read_packed(spark, empty).count() == 0 and len(packed_ids.ids_between(empty, 0, 9)) == 0


def test_long_texts_are_encoded_in_slices_and_memory_is_begun_anew(monkeypatch):
    words = packed_ids.WordIds(TOKENIZER)
    text = " ".join(f"word{i % 977}, it's\n" for i in range(20_000)) + "x" * 3000
    monkeypatch.setattr(packed_ids, "SLICE_BYTES", 10_000)
    monkeypatch.setattr(packed_ids, "WORDS_HELD", 100)
    assert b"".join(packed_ids.slices(text.encode(), 777)) == text.encode()
    data = np.frombuffer(text.encode(), np.uint8)
    ids, counts = words.rows(data, np.array([0, len(data)]))
    assert ids.tolist() == encoded([text])[0][:-1] and counts.tolist() == [len(ids)]


def test_query_on_the_given_documents(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    start, expected = 0, []
    for (doc_id, _), ids in zip(docs, encoded(t for _, t in docs)):
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op11_packed_ids"](spark, sf_dir).collect())) == expected
