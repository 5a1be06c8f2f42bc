"""Mixing, Hilbert sharding and the pipeline."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapflow.llm import hilbert, mixing
from tapflow.llm.queries import QUERIES
from tests.llm import cases


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def mixed_table(spark, seed=2):
    rng = random.Random(seed)
    sizes = {"a": 30, "b": 5, "c": 80, None: 20, "É": 2, "": 3}
    rows = [(i, cases.sentence(rng, rng.randrange(0, 300)), "en", s, 0) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [(900, None, "en", "a", 0), (900, None, "en", "a", 0), (None, "one two", "en", "a", 0), (901, "x y", "en", "empty", 0), (902, "", "en", "void", 0)]
    return spark.createDataFrame(rows, cases.SCHEMA)


def test_mixture_meets_its_targets(spark):
    docs = mixed_table(spark)
    found = mixing.mixture_report(docs.withColumn("size", F.lit("x")), [3, 1, 2], 1.5, block=16)
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by_id = {r.doc_id: r for r in docs.collect() if r.doc_id is not None}
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(cases.words(r.text))
    target, taken = brute_targets(sizes), {}
    for r in rows:
        source = by_id[r.doc_id].source if r.doc_id is not None else "a"
        assert r.target == pytest.approx(target[source]) and r.source_size == sizes[source]
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    again = mixing.mixture_report(docs.repartition(7), [3, 1, 2], 1.5, block=16)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))
    assert mixing.mixture_report(docs.limit(0), [3, 1, 2], 1.5).count() == 0


def test_draws_fill_every_slot_of_every_shard(spark):
    _, draws = mixing.mixed(mixed_table(spark), [3, 1, 2], 1.5, block=16, shards=5)
    slots = draws.select("shard", "slot").distinct().groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last")).collect()
    assert len(slots) == 5 and all(r.n == r["last"] + 1 for r in slots)
    assert max(r.n for r in slots) - min(r.n for r in slots) <= 1


def test_permutations_are_one_to_one(spark):
    for n in (1, 2, 3, 10, 997):
        found = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p")).collect()
        assert sorted(r.p for r in found) == list(range(n))


def test_mixed_documents_hold_the_words_taken(spark):
    docs = mixed_table(spark).where("doc_id < 900")
    rows = mixing.mixed_documents(docs, [3, 1, 2], 1.5, block=16).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    taken = {r.doc_id: r.taken for r in mixing.mixture_report(docs, [3, 1, 2], 1.5, block=16).collect()}
    found = {}
    for r in rows:
        rest = iter(cases.words(texts[r.doc_id]))
        assert all(word in rest for word in cases.words(r.text)) and r.n_chars == len(r.text)  # in order
        found[r.doc_id] = found.get(r.doc_id, 0) + len(cases.words(r.text))
    assert found == {i: n for i, n in taken.items() if n}
    assert mixing.mixed_documents(docs.limit(0), [3, 1, 2], 1.5).columns == docs.columns


@pytest.mark.parametrize("dims", [2, 3, 4])
def test_neighbours_on_the_curve_touch(spark, dims):
    bits = 2
    points = spark.range(1 << (bits * dims)).select(*[
        F.shiftright("id", bits * d).bitwiseAND(F.lit(3)).alias(f"d{d}") for d in range(dims)
    ])
    names = [f"d{d}" for d in range(dims)]
    rows = sorted((r.i, *(r[n] for n in names)) for r in points.select(*names, hilbert.hilbert_index([F.col(n) for n in names], bits).alias("i")).collect())
    assert [r[0] for r in rows] == list(range(len(rows)))
    assert all(sum(abs(a - b) for a, b in zip(x[1:], y[1:])) == 1 for x, y in zip(rows, rows[1:]))


def test_shards_of_awkward_rows(spark):
    rows = [(i % 7 if i % 5 else None, None if i % 4 == 0 else "s", i % 3, f"t{i % 2}") for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, shard string")
    found = hilbert.hilbert_shards(df, ["source", "size"], 8, ["doc_id"]).collect()
    counts = {}
    for r in found:
        counts.setdefault(r.shard, []).append(r.slot)
    assert sorted(counts) == list(range(8)) and all(sorted(x) == list(range(len(x))) for x in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert hilbert.hilbert_shards(df.limit(0), ["source", "size"], 8, ["doc_id"]).count() == 0
    few = hilbert.hilbert_shards(df.limit(3), ["source", "size"], 8, ["doc_id"]).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_columns_stay_whatever_their_names(spark):
    names = ["_at", "_place", "_part", "_offset", "_0", "_1", "row", "at", "key_a", "key_b", "number", "block", "tie_0", "before", "n"]
    df = spark.createDataFrame([(i, f"w{i} x y z", "s", i) for i in range(40)], "doc_id long, text string, source string, size long").withColumns({n: F.concat(F.lit(f"{n} of "), "doc_id") for n in names})
    for found in (hilbert.hilbert_shards(df, ["source", "size"], 4, ["doc_id"]), mixing.mixed_documents(df, [1], 1.0, block=4)):
        rows = found.collect()
        assert len(rows) >= 40 and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)


def test_a_filter_on_two_dimensions_opens_few_shards(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, f"source{rng.randrange(30):02d}", rng.choice(["de", "en", "fr"]), rng.randrange(10_000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, size long").repartition(4)
    dims = ["source", "lang", "size"]
    placed = hilbert.hilbert_shards(df, dims, 64, ["doc_id"])
    hilbert.write_shards(placed, str(tmp_path / "shards"))
    stored = spark.read.parquet(str(tmp_path / "shards"))
    assert stored.count() == 6000
    ranges = hilbert.shard_ranges(stored, dims).collect()
    assert len(ranges) == 64 and sum(r.n_rows for r in ranges) == 6000
    wanted = lambda r: r.min_source <= "source07" <= r.max_source and r.min_size <= 2500 and r.max_size >= 2000
    opened = [r.shard for r in ranges if wanted(r)]
    inside = stored.where("source = 'source07' AND size BETWEEN 2000 AND 2500")
    assert {r.shard for r in inside.collect()} <= set(opened) and len(opened) <= 64 / 4
    cells = df.select(hilbert.cells(df, ["source"])[0].alias("c"), "source").distinct().collect()
    order = [r.c for r in sorted(cells, key=lambda r: r.source)]
    assert order == sorted(order) and len(set(order)) > 25


def test_shard_and_mixture_queries(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_hilbert_shards"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(docs) and {r.law for r in rows} == {"rows"}
    assert all(r["size"] == len((docs[r.doc_id].text or "").encode()) + 16 for r in rows)
    assert all(r.text_crc32 == zlib.crc32((docs[r.doc_id].text or "").encode()) and r.grown_shard is None for r in rows)
    counts = [sum(r.shard == s for r in rows) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in range(40))
    curve = [r.curve_index for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)
    assert {r.doc_id for r in QUERIES["op7_mixture"](spark, sf_dir).collect()} == set(docs)


def test_pipeline_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixture", "sharding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    everything, columns = {r.doc_id for r in docs.collect()}, docs.columns
    final = corpus_pipeline.run(spark, sf_dir)
    rows = final.collect()
    assert set(columns) < set(final.columns) and {r.doc_id for r in rows} <= everything
    sizes = [sum(r.shard == s for r in rows) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1
    leaked = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert not [r.doc_id for r in rows if any(x in r.text for x in leaked)]


def test_pipeline_hands_texts_over_in_small_batches(spark):
    """Whatever the stage runs next, no Python worker gets 64 MB of texts at once."""
    import pyarrow as pa

    from tapflow.llm import store

    def largest(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max((b.nbytes for b in batches), default=0)])], ["n"])

    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat(string(id), 4000)").alias("text")).coalesce(1)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    try:
        corpus_pipeline.small_batches(spark)
        assert docs.mapInArrow(largest, "n long").first().n < 2 * store.BATCH_BYTES
        spark.conf.set(limit, str(1 << 20))
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(limit) == str(1 << 20)
    finally:
        spark.conf.unset(limit)


def test_pipeline_of_awkward_documents(spark, sf_dir):
    docs = spark.createDataFrame(cases.rows(cases.awkward_texts()) + [(None, "x", None, None, None)], cases.SCHEMA)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, sf_dir)
            assert table.columns == docs.columns
            table = spark.createDataFrame(table.collect(), cases.SCHEMA)
        corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).collect()
