"""Hashes of words, lines and windows on texts made to collide."""

import random

import numpy as np
from pyspark.sql import functions as F

from tapflow.llm import block_dedup, near_dups, rules, text, tiling
from tapflow.llm.store import hash_sample
from tests.llm import cases

DOCS = "doc_id long, text string"


def morse(n, a="a", b="b"):
    """2**n letters by the Thue-Morse rule and their complement; they collide modulo 2**64 from n = 10 on."""
    one = a
    for _ in range(n):
        one += one.translate(str.maketrans(a + b, b + a))
    return one, one.translate(str.maketrans(a + b, b + a))


def test_hashes_are_polynomials_modulo_the_prime():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)
    total, power, expected = 0, 1, [0]
    for byte in data.tolist():
        total = (total + (byte + 1) * power) % text.PRIME
        power = power * text._POINT % text.PRIME
        expected.append(total)
    assert text.byte_prefix(data).tolist() == expected
    assert text.prefix(data.astype(np.uint64) + np.uint64(1)).tolist() == expected
    a, b = (np.append(rng.integers(0, text.PRIME, 500, dtype=np.uint64), np.uint64(text.PRIME - 1)) for _ in range(2))
    assert text.times(a, b).tolist() == [int(x) * int(y) % text.PRIME for x, y in zip(a, b)]


def test_spans_are_the_same_wherever_their_content_stands():
    rng = np.random.default_rng(2)
    content = rng.integers(0, 2 ** 64 - 1, 500, dtype=np.uint64, endpoint=True)
    values = np.concatenate([content, rng.integers(0, 9, 400_000, dtype=np.uint64), content, content])
    starts = np.array([0, 400_500, 401_000])
    found = text.spans(text.prefix(values), starts, starts + 500)
    assert len(set(found.tolist())) == 1
    assert len(set(text.spans(text.prefix(values), starts, starts + np.array([499, 500, 498])).tolist())) == 3


def test_words_and_lines_by_the_thue_morse_rule_differ(spark):
    one, other = morse(11)
    rest = cases.sentence(random.Random(4), 19)
    docs = spark.createDataFrame([(1, f"{rest} {one}"), (2, f"{rest} {other}")], DOCS)
    assert [r.spans for r in block_dedup.remove_repeats(docs).orderBy("doc_id").collect()] == [[], []]
    docs = spark.createDataFrame([(1, f"{one} b c d e"), (2, f"{other} b c d e")], DOCS)
    assert all(r.kept for r in near_dups.near_duplicates(docs).collect())
    data = np.frombuffer(f"{one}\n{other}\n{one}\n".encode(), np.uint8)
    assert rules.counted(data, np.array([0, len(data)]))["n_dup_lines"].tolist() == [1]
    items = spark.createDataFrame([(7, f"{one} b c d e")], "item_id long, text string")
    assert [r.n_items for r in tiling.flagged(docs, items, shortest=5, covered=1.0).orderBy("doc_id").collect()] == [1, 0]


def test_windows_of_words_by_the_thue_morse_rule_differ():
    one, other = morse(11, "x", "y")
    for size in (len(one), len(one) - 3):
        data = np.frombuffer((" ".join(one) + " . " + " ".join(other)).encode(), np.uint8)
        starts, ends, first = text.words(data, np.array([0, len(data)]))
        hashes, at = text.window_hashes(text.word_hashes(data, starts, ends), first, size)
        windows = {}
        for place, value in zip(at.tolist(), hashes.tolist()):
            windows.setdefault(value, set()).add((one + "." + other)[place: place + size])
        assert all(len(x) == 1 for x in windows.values())


def test_samples_of_repeated_rows_are_as_large_as_asked(spark):
    same = spark.range(5000).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"))
    assert hash_sample(same, ["doc_id", "text"], 300).count() == 300
    assert hash_sample(same.limit(0), ["doc_id"], 300).count() == 0
    assert hash_sample(spark.range(50), ["id"], 300).count() == 50


def test_forest_on_repeated_rows_judges_them_alike(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(cases.sentence(random.Random(5), 40)).alias("text"))
    found = rules.quality_rules(docs, labels).select("anomaly", "kept").distinct().collect()
    assert len(found) == 1 and found[0].kept
