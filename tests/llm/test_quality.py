"""Rules with isolation forest, the byte network and benchmark tiling."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.llm import byte_conv, rules, tiling
from tapflow.llm.queries import QUERIES
from tests.llm import cases

NO_LABELS = "doc_id long, quality int, toxic int"


def documents(spark, texts, extra=()):
    return spark.createDataFrame(cases.rows(texts) + list(extra), cases.SCHEMA)


def brute_counts(text):
    text = text or ""
    own = cases.words(text)
    runs = Counter(tuple(own[i:i + 5]) for i in range(len(own) - 4))
    repeated = [False] * len(own)
    for i in range(len(own) - 4):
        if runs[tuple(own[i:i + 5])] > 1:
            repeated[i:i + 5] = [True] * 5
    lines = [x for x in text.split("\n") if cases.words(x)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(repeated))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_rule_counts_equal_brute_force(spark):
    texts = cases.awkward_texts() + ["a b c d e x a b c d e", "\n\n a \n a\n a \n", "| |\n| |\n"]
    found = {r.doc_id: tuple(r)[1:] for r in rules.statistics(documents(spark, texts)).select("doc_id", *BASE).collect()}
    assert found == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_rules_keep_clean_and_reject_junk(spark):
    rng = random.Random(3)
    clean = [cases.sentence(rng, rng.randrange(30, 200)) for _ in range(300)]
    junk = [" ".join(w + "###" for w in cases.sentence(rng, 60).split()) for _ in range(30)]
    docs = documents(spark, clean + junk + [None, "", "few words"])
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(0, 330, 2)], NO_LABELS)
    kept = {r.doc_id for r in rules.quality_rules(docs, labels).where("kept").collect()}
    assert len(kept & set(range(300))) >= 297 and not kept & set(range(300, 333))
    carried = rules.quality_rules(docs.withColumn("n_words", F.lit("own")), labels, carry=True)
    assert carried.columns == [*docs.columns, "n_words"]
    assert {r.doc_id for r in carried.collect()} == kept


def test_rules_without_labels_or_rows(spark):
    none = spark.createDataFrame([], NO_LABELS)
    text = cases.sentence(random.Random(1), 40)
    docs = documents(spark, [text, text, None], [(None, text, None, None, None)])
    found = sorted((repr(r.doc_id), r.kept) for r in rules.quality_rules(docs, none).collect())
    assert found == [("0", True), ("1", True), ("2", False), ("None", True)]
    assert rules.quality_rules(documents(spark, []), none).count() == 0


def test_forest_scores_outliers_higher():
    rows = np.random.default_rng(2).normal(size=(2000, 3))
    forest = rules.IsolationForest(rows)
    scores = forest.score(np.array([[0.0, 0, 0], [9.0, 9, 9]]))
    assert scores[1] > 0.6 > 0.5 > scores[0]


def test_network_covers_whole_texts_and_learns(spark):
    for size in (0, 1, 127, 128, 129, 224, 225, 1000):
        covered = np.zeros(max(size, 1), bool)
        for start in byte_conv.chunk_starts(size):
            covered[start: start + byte_conv.CHUNK] = True
        assert covered.all()
    rng = random.Random(8)
    texts = [cases.sentence(rng, 80) if i % 2 else cases.sentence(rng, 80).upper() for i in range(400)] + [None, ""]
    docs = documents(spark, texts, [(None, "WORDS", None, None, None)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], NO_LABELS)
    found = {r.doc_id: r for r in byte_conv.quality_scores(docs.withColumn("score", F.lit("x")), labels).collect()}
    held = [i for i in range(400) if found[i].held_out]
    assert held == [i for i in range(400) if byte_crc(i) % 3 == 1]
    assert np.mean([found[i].predicted == i % 2 for i in held]) > 0.95
    assert 0 <= found[400].score <= 1 and found[400].score == found[401].score and not found[None].held_out


def byte_crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_network_without_labels_or_rows(spark):
    none = spark.createDataFrame([], NO_LABELS)
    assert {r.score for r in byte_conv.quality_scores(documents(spark, ["a", None]), none).collect()} == {0.5}
    assert byte_conv.quality_scores(documents(spark, []), none).count() == 0


def test_network_gradient_matches_differences():
    draw = np.random.default_rng(4)
    network = byte_conv.ByteNetwork()
    network.weights = {k: w.astype(float) for k, w in network.weights.items()}
    codes, owner = draw.integers(0, 257, (6, byte_conv.CHUNK)), np.array([0, 0, 1, 1, 1, 2])
    labels, weights = np.array([0, 1, 1]), np.ones(3)

    def loss():
        _, _, top = network.pooled(codes)
        score = np.bincount(owner, np.maximum(top, 0) @ network.weights["out"] + network.weights["base"][0]) / np.bincount(owner)
        return np.mean(np.log1p(np.exp(score)) - labels * score)

    slopes = network._slopes(codes, owner, labels, weights)
    for name, place in [("out", 3), ("bias", 5), ("filters", (7, 2)), ("base", 0), ("embed", (int(codes[0, 20]), 1))]:
        kept = network.weights[name][place]
        network.weights[name][place] = kept + 1e-5
        high = loss()
        network.weights[name][place] = kept - 1e-5
        low = loss()
        network.weights[name][place] = kept
        assert slopes[name][place] == pytest.approx((high - low) / 2e-5, abs=1e-4)


def slow_tiles(text, item, shortest):
    """Plain greedy tiling: the longest free match again and again."""
    free_a, free_b, tiles = [True] * len(text), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while i + n < len(text) and j + n < len(item) and free_a[i + n] and free_b[j + n] and text[i + n] == item[j + n]:
                    n += 1
                if n > best[2]:
                    best = (i, j, n)
        if best[2] < shortest:
            return tiles
        i, j, n = best
        free_a[i:i + n] = [False] * n
        free_b[j:j + n] = [False] * n
        tiles.append(best)


@pytest.mark.parametrize("seed", range(8))
def test_tiles_equal_plain_greedy_tiling(seed):
    rng = np.random.default_rng(seed)
    item = rng.integers(0, 12 if seed % 2 else 400, 40).astype(np.uint64)
    blocks = [item[a: a + rng.integers(3, 20)] for a in rng.integers(0, 36, 6)]
    text = np.concatenate([x for b in blocks for x in (b, rng.integers(0, 500, rng.integers(0, 9)).astype(np.uint64))])
    assert sorted(tiling.greedy_tiles(text, item, 4)) == sorted(slow_tiles(text.tolist(), item.tolist(), 4))


def test_reordered_passages_are_caught_and_clean_texts_left(spark, monkeypatch):
    rng = random.Random(6)
    item = cases.sentence(rng, 40)
    own = item.split()
    moved = " ".join(own[20:] + ["between"] * 7 + own[:20])
    half = " ".join(own[:14])
    texts = [cases.sentence(rng, 50), f"{cases.sentence(rng, 10)} {item.upper()}! {cases.sentence(rng, 5)}", moved, half, None, "", cases.sentence(rng, 9000) + " " + item]
    docs = documents(spark, texts, [(None, item, None, None, None), (1, texts[1], "en", "s", 0)]).withColumn("item_id", F.lit(7))
    items = spark.createDataFrame([(0, item), (1, "too short"), (2, None), (None, item), (3, cases.sentence(rng, 30)), (0, item)], "item_id long, text string")
    for most in (tiling.MOST_BITS, tiling.PIECE_BITS):
        monkeypatch.setattr(tiling, "MOST_BITS", most)
        found = {r.doc_id: r for r in tiling.flagged(docs, items).collect()}
        assert {i for i, r in found.items() if r.contaminated} == {1, 2, 6}
        assert found[2].items == [0] and found[2].share == 1.0 and not found[None].contaminated
    assert tiling.flagged(documents(spark, []), items).count() == 0
    assert tiling.contaminated(docs, items.limit(0)).count() == 0


def test_the_seed_filter_passes_every_seed(spark):
    rng = np.random.default_rng(9)
    held = rng.integers(-2 ** 63, 2 ** 63 - 1, 40_000)
    index = spark.createDataFrame([(int(x), 1) for x in held], "seed long, item_id long").repartition(5)
    bitmap = tiling.seed_filter(index, len(held))
    assert len(bitmap) * 8 == 1 << 20 and tiling.passes(bitmap, held.view(np.uint64)).all()
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 40_000).view(np.uint64)
    assert tiling.passes(bitmap, others).mean() < 0.08
    assert not tiling.seed_filter(index.limit(0), 0).any()


def test_tiling_query_equals_plain_greedy_tiling(spark, sf_dir):
    def tokens(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())

    docs = {r.doc_id: tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: tokens(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    seeds = {}
    for item, own in items.items():
        for i in range(len(own) - 4):
            seeds.setdefault(tuple(own[i:i + 5]), set()).add(item)
    expected = {}
    for doc, own in docs.items():
        near = {item for i in range(len(own) - 4) for item in seeds.get(tuple(own[i:i + 5]), ())}
        expected[doc] = sorted(x for x in near if sum(n for *_, n in slow_tiles(own, items[x], 5)) * 2 >= len(items[x]))
    found = {r.doc_id: r["items"] for r in QUERIES["op4_string_tiling"](spark, sf_dir).collect()}
    assert found == expected and any(found.values())


def test_quality_queries_on_the_given_documents(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op10_byte_network"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad) > 0.9
    verdicts = QUERIES["op2_isolation_rules"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: tuple(getattr(r, c) for c in BASE) for r in verdicts} == {i: brute_counts(t) for i, t in texts.items()}
    for r in verdicts:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    past = [r for r in verdicts if not r.base_failed]
    least = min((r.anomaly for r in past if not r.kept), default=2)
    assert all(r.kept == (r.anomaly < least) for r in past) and len({r.anomaly for r in past}) > len(past) / 2
    assert sum(r.kept for r in past if labels.get(r.doc_id) == 1) >= 0.97 * sum(labels.get(r.doc_id) == 1 for r in past)
