"""Best Position search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.llm import best_position
from tests.llm import cases

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_force(docs, items, k):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_docs, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item, own in asked.items():
        scores = []
        for doc_id, bag in bags:
            m = 50 + (50 * sum(bag.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in own if bag[t])
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return out


def found(spark, docs, items, k, **options):
    rows = best_position.ranked(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), k, **options).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed,shard_docs", [(1, 7), (2, 64), (3, 8192)])
def test_equal_to_scoring_every_document(spark, seed, shard_docs):
    rng = random.Random(seed)
    docs = [(i, " ".join(f"t{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    docs += [(1000 + i, text) for i, (_, text) in enumerate(docs[:40])] + docs[:5] + [(None, docs[0][1]), (None, docs[1][1])]
    items = [(i, " ".join(f"t{int(rng.paretovariate(0.5))}" for _ in range(rng.randrange(1, 25)))) for i in range(15)]
    expected = sorted(brute_force(docs, items, 20), key=repr)
    assert found(spark, docs, items, 20, shard_docs=shard_docs) == expected
    assert found(spark, docs, items, 20, shard_docs=shard_docs, pass_terms=30) == expected


def test_awkward_texts(spark):
    docs = list(enumerate(cases.awkward_texts())) + [(90, "É é ÀB\x00cd E-mail: x_y"), (91, "#$%"), (92, "😀 ok OK")]
    items = [(1, None), (2, ""), (3, "!!"), (4, "one TWO three"), (5, "é x y"), (6, "É cd àB"), (7, "absent"), (None, "line ok"), (8, cases.awkward_texts()[6]), (8, "one")]
    assert found(spark, docs, items, 5) == sorted(brute_force(docs, items, 5), key=repr)


def test_empty_tables_and_clashing_columns(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], DOCS)
    items = spark.createDataFrame([(1, "a")], ITEMS).withColumns({"term": F.lit(1), "score": F.lit(2), "doc_id": F.lit(3)})
    assert best_position.ranked(none, items).count() == 0
    assert best_position.ranked(some, items.limit(0)).count() == 0
    assert best_position.ranked(some.where("doc_id > 1").withColumn("item", F.lit(1)), items).columns == ["item_id", "rank", "doc_id", "score"]
    assert best_position.ranked(some.withColumns({"terms": F.lit(1), "counts": F.lit(2)}), items).count() == 1


def test_best_positions_stop_no_later_than_last_read_positions():
    rng = np.random.default_rng(5)
    n, lists, k = 4000, 6, 10
    terms_of = [np.flatnonzero(rng.random(n) < 0.5) for _ in range(lists)]
    places = np.concatenate(terms_of)
    counts = rng.zipf(1.7, len(places)).clip(max=100_000)
    shard = best_position.Shard(
        np.full(n, 200), np.arange(lists), np.array(list(map(len, terms_of))), places, counts, np.full(lists, 500), n, 200 * n
    )
    docs, scores, depth = shard.best(np.arange(lists), k)
    whole = np.zeros(n, np.int64)
    np.add.at(whole, shard.doc, shard.impact)
    expected = sorted(zip(-whole, range(n)))[:k]
    assert sorted(zip(-scores, docs))[:k] == expected
    # the threshold algorithm adds the impacts at the last positions read
    met, stop = set(), None
    for at in range(max(map(len, terms_of))):
        own = [shard.bounds[i] + at for i in range(lists) if shard.bounds[i] + at < shard.bounds[i + 1]]
        met |= set(shard.doc[own].tolist())
        if len(met) >= k and shard.impact[own].sum() < sorted(whole[list(met)])[-k]:
            stop = at + 1
            break
    assert depth < n / 4 and depth < 2 * stop + best_position.FIRST_DEPTH
    again = shard.best(np.arange(lists), k)
    assert again[2] == depth and sorted(zip(-again[1], again[0]))[:k] == expected
    assert len(shard.best(np.arange(lists), k, floor=int(scores.max()) + 1)[0]) <= len(docs)
