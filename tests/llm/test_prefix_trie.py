"""The trie of rebuilt conversations against dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tapflow.llm import prefix_trie
from tests.llm import cases

TURNS = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [x for _, x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    below, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            below[path[:-1]] += 1
    for path, own_members in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not below[path]
            saved[path[:d]] += (len(own_members) - 1) * len(cases.words(path[-1][1])) if path else 0
    out = []
    for path, own_members in members.items():
        ends = sorted(c for c in own_members if whole[c] == path)
        out.append((
            min(own_members), len(path), min(members[path[:-1]]) if path else None, len(own_members), below[path], leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    return sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(3), **options).collect()), key=repr)


@pytest.mark.parametrize("seed,shards", [(1, 1), (2, 3), (3, 17)])
def test_equal_to_dictionaries_of_prefixes(spark, seed, shards):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(0, 260), *rng.sample(range(-90, 0), 30), 10 ** 15 + 20, 10 ** 15 + 27]:
        if rng.random() < 0.1:
            continue
        kind = rng.random()
        if kind < 0.4:  # a third and more are copies of one conversation
            rows += [(conv, t, "user", f"common turn {t}") for t in range(6)]
        elif kind < 0.7:
            rows += [(conv, t, rng.choice(["user", "assistant"]), f"word {rng.randrange(3)} é\x0b x") for t in range(rng.randrange(1, 7))]
        else:
            rows.append((conv, 0, "user", "short"))
    rows += [(4000, t, "user", f"deep {t % 5}") for t in range(300)] + [(4001, t, "user", f"deep {t % 5}") for t in range(299)]
    rng.shuffle(rows)
    assert found(spark, rows, shards=shards) == brute_force(rows)


def test_missing_values_ties_and_turnless_conversations(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, None, "", ""), (1, 2, "a", "b c"), (1, 2, "a", "b c"), (1, 2, "A", None),
            (0, 0, "user", ""), (0, 1, "userx", "y"), (20, 0, "user", "x"), (21, 5, "user", "x"), (22, -1, "use", "rx"), (41, 1, "u", "no base")]
    rows += [(c, 0, "u", "only") for c in range(60, 80)] + [(c, 0, "u", "lonely") for c in range(101, 119)]
    expected = brute_force(rows)
    root = next(x for x in expected if x[1] == 0)
    assert root[7] != prefix_trie.NOTHING, "some conversation has no turn left"
    for shards in (1, 5):
        assert found(spark, rows, shards=shards) == expected


def test_empty_table_and_clashing_columns(spark):
    turns = spark.createDataFrame([(7, 0, "user", "hello there")], TURNS)
    assert prefix_trie.prefix_trie(turns.limit(0)).count() == 0
    clashing = turns.withColumns({c: F.lit("clash") for c in ("path", "words", "shard", "node", "turns", "head", "base", "digest")})
    assert found(spark, [(7, 0, "user", "hello there")]) == sorted(map(tuple, prefix_trie.prefix_trie(clashing).collect()), key=repr)


def test_long_texts_and_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (0, 20, 40) for t in range(3000)] + [(60, 0, "user", "word " * 200_000), (80, 0, "user", "word " * 200_000)]
    assert found(spark, rows, shards=4) == brute_force_chain(rows)


def brute_force_chain(rows):
    """As brute_force, for few long conversations that are whole copies of each other or differ from the start."""
    groups = defaultdict(list)
    for conv in sorted({r[0] for r in rows}):
        groups[tuple(r[1:] for r in rows if r[0] == conv)].append(conv)
    out, total = [], 0
    for path, members in groups.items():
        words = [len(cases.words(x[2])) for x in path]
        for d in range(len(path), 0, -1):
            end = hashlib.sha256(",".join(map(str, members)).encode() if d == len(path) else b"").hexdigest()
            above = members[0] if d > 1 else min(min(x) for x in groups.values())
            out.append((members[0], d, above, len(members), int(d < len(path)), 1, (len(members) - 1) * sum(words[d - 1:]), end))
        total += (len(members) - 1) * sum(words)
    out.append((min(min(x) for x in groups.values()), 0, None, sum(map(len, groups.values())), len(groups), len(groups), total, hashlib.sha256(b"").hexdigest()))
    return sorted(out, key=repr)


def test_only_nodes_across_borders_are_in_the_skeleton(spark):
    rows = [(c * 20, t, "user", f"{c} {t}") for c in range(200) for t in range(4)]
    ordered = prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.original(spark.createDataFrame(rows, TURNS)))).repartitionByRange(
        8, "path", "conv_id"
    ).withColumn("shard", F.spark_partition_id())
    assert prefix_trie.splitters(ordered) == [b""]
    same = spark.createDataFrame([(c * 20, t, "user", f"{t}") for c in range(200) for t in range(4)], TURNS)
    ordered = prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.original(same))).repartitionByRange(8, "path", "conv_id").withColumn("shard", F.spark_partition_id())
    assert ordered.select("shard").distinct().count() > 4
    assert [len(x) for x in prefix_trie.splitters(ordered)] == [64]
