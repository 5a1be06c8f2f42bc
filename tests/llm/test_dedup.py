"""Near-duplicates, repeated passages and repeated strings against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.llm import block_dedup, suffix_dedup
from tapflow.llm.components import components
from tapflow.llm.near_dups import MinHash, corrected, near_duplicates
from tapflow.llm.queries import QUERIES
from tapflow.llm.scatter import packed_places, unpacked_places
from tests.llm import cases


def documents(spark, texts, extra=()):
    return spark.createDataFrame(cases.rows(texts) + list(extra), cases.SCHEMA)


def brute_components(texts):
    sets = [cases.shingles(t) for t in texts]
    links = [
        (a, b) for a, b in combinations(range(len(sets)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), root) for i, root in cases.components(links, range(len(sets))).items()}


def test_near_duplicates_equal_brute_force_on_awkward_texts(spark):
    texts = cases.awkward_texts()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, texts)).collect()}
    assert found == brute_components(texts)


def test_near_duplicates_in_a_group_that_needs_more_than_one_hub(spark):
    rng = random.Random(4)
    base = cases.sentence(rng, 120).split()
    texts = []
    for edits in range(60):
        own = list(base)
        for at in rng.sample(range(120), edits % 12):
            own[at] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(own))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(documents(spark, texts)).collect()}
    assert found == brute_components(texts)


def test_near_duplicates_of_null_ids_and_repeated_rows(spark):
    texts = ["a b c d e f g", "a b c d e f g"]
    df = documents(spark, texts, [(None, "a b c d e f g", None, None, None), (1, "a b c d e f g", "en", "s", 13)])
    found = sorted(map(tuple, near_duplicates(df).select("doc_id", "component_id", "kept").collect()), key=repr)
    assert found == sorted([(0, 0, True), (1, 0, False), (1, 0, False), (None, 0, False)], key=repr)


def test_near_duplicates_of_empty_tables_and_clashing_columns(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    df = documents(spark, ["a b", "a b"]).withColumns({c: F.lit(1) for c in ("rep", "n", "key", "digest", "component_id")})
    assert {r.component_id for r in near_duplicates(df).collect()} == {0}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    family = MinHash(1024, 4, 4)
    pool = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    for share in (0.2, 0.5, 0.75, 0.95):
        n = int(2000 * share)
        a, b = pool[:2000], np.concatenate([pool[:n], pool[2000:2000 + (2000 - n)]]) if n >= 1000 else np.concatenate([pool[:n], rng.integers(0, 2 ** 63, 2000 - n).astype(np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x = family.packed(family.minima(a)).view(np.uint64) ^ family.packed(family.minima(b)).view(np.uint64)
        apart = sum(int(((x >> np.uint64(4 * g)) & np.uint64(15) != 0).sum()) for g in range(16))
        assert abs(corrected(1024 - apart, 1024, 4) - true) < 0.07


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 199), (199, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for pair in links[:-4] for x in pair} | {199, 200}
    assert found == cases.components([x for x in links if None not in x], nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def word_results(df, **options):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["start"])
    found = block_dedup.remove_repeats(df, **options)
    return found.select("doc_id", "n_words", removed.alias("n"), F.sha2("kept_text", 256).alias("sha"), F.size("spans").alias("spans"))


def byte_results(df, **options):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda t, x: t + x["end"] - x["start"])
    found = suffix_dedup.remove_repeats(df, **options)
    return found.select("doc_id", "n_bytes", removed.alias("n"), F.sha2("kept", 256).alias("sha"), F.size("spans").alias("spans"))


def crowded(seed):
    """Passages shared by many texts, cut at many places, some inside one text."""
    rng = random.Random(seed)
    passages = [cases.sentence(rng, rng.randrange(15, 80)) for _ in range(4)]
    texts = []
    for _ in range(80):
        own = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(passages).split()
            low = rng.randrange(len(part))
            own += [cases.sentence(rng, rng.randrange(0, 30)), " ".join(part[low: low + rng.randrange(len(part))])]
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("options", [{}, {"chunk": 2000, "part": 5000}])
@pytest.mark.parametrize("texts", [cases.awkward_texts(), crowded(2)], ids=["awkward", "crowded"])
def test_block_anchors_equal_brute_force(spark, texts, options):
    expected = cases.without_repeats(texts, cases.words, lambda x: " ".join(x).encode(), 20)
    found = {r[0]: tuple(r)[1:] for r in word_results(documents(spark, texts), **options).collect()}
    assert found == dict(enumerate(expected))


@pytest.mark.parametrize("options", [{}, {"chunk": 3000, "part": 5000}, {"chunk": 3000, "part": 5000, "large": 2}])
@pytest.mark.parametrize("texts", [cases.awkward_texts(), crowded(3)], ids=["awkward", "crowded"])
def test_suffix_sort_equals_brute_force(spark, texts, options):
    expected = cases.without_repeats(texts, lambda t: (t or "").encode(), bytes, 100)
    found = {r[0]: tuple(r)[1:] for r in byte_results(documents(spark, texts), **options).collect()}
    assert found == dict(enumerate(expected))


def test_repeats_of_rows_without_id_and_empty_tables(spark):
    text = cases.sentence(random.Random(9), 40)
    df = documents(spark, [text, text], [(None, text, None, None, None)])
    for build in (word_results, byte_results):
        found = {r[0]: r["n"] for r in build(df).collect()}
        assert found[None] == 0 and found[0] == 0 and found[1] > 0
        assert build(documents(spark, [])).count() == 0
    assert byte_results(df.withColumn("chunk", F.lit(1)).withColumn("part", F.lit("x"))).count() == 3


def test_far_apart_ids_keep_their_order(spark):
    text = cases.sentence(random.Random(2), 60)
    ids = [-(2 ** 63), -5, 0, 7, 2 ** 63 - 1]
    df = spark.createDataFrame([(i, text, "en", "s", 0) for i in reversed(ids)], cases.SCHEMA)
    for build in (word_results, byte_results):
        assert {r[0] for r in build(df, chunk=50).where("n = 0").collect()} == {ids[0]}


def test_sorted_suffixes_and_common_prefixes():
    rng = np.random.default_rng(5)
    rows = rng.integers(1, 3, (300, 12)).astype(np.int16)
    bucket = np.sort(rng.integers(0, 7, 300))
    order, shared = suffix_dedup.sorted_suffixes(rows, bucket)
    expected = sorted(range(300), key=lambda i: (bucket[i], rows[i].tolist()))
    assert [rows[i].tolist() for i in order] == [rows[i].tolist() for i in expected]
    for at in range(1, 300):
        if bucket[at] == bucket[at - 1]:
            same = rows[order[at]] == rows[order[at - 1]]
            assert shared[at] == (12 if same.all() else np.argmin(same))


def test_packed_places_round_trip():
    places = np.cumsum(np.random.default_rng(1).integers(1, 2000, 500))
    for kept in (places, places - places[0], np.zeros(0, np.int64), np.array([254, 255, 510, 511])):
        assert (unpacked_places(packed_places(kept)) == kept).all()


def test_queries_on_the_given_tables(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in docs]
    expected = cases.without_repeats(texts, cases.words, lambda x: " ".join(x).encode(), 20)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.n_spans) for r in QUERIES["op9_block_anchors"](spark, sf_dir).collect()}
    assert found == {r.doc_id: x for r, x in zip(docs, expected)}
    expected = cases.without_repeats(texts, lambda t: (t or "").encode(), bytes, 100)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256, r.n_spans) for r in QUERIES["op6_suffix_sort"](spark, sf_dir).collect()}
    assert found == {r.doc_id: x for r, x in zip(docs, expected)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_near_duplicates"](spark, sf_dir).collect()} == {
        docs[i].doc_id: (n, docs[root].doc_id) for i, (n, root) in brute_components(texts).items()
    }


def test_components_are_not_found_again_without_new_links(spark, monkeypatch):
    """Two copies with one word changed: the first round links them, and no later one has links."""
    from tapflow.llm import near_dups

    calls, real = [], near_dups.components
    monkeypatch.setattr(near_dups, "components", lambda links: calls.append(1) or real(links))
    long = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "a b c d e f g")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert len(calls) == 1  # 3 before
