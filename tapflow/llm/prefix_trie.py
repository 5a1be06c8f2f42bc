"""Trie of conversation prefixes, built from sorted shards under a skeleton of splitter paths.

A path is the sequence of a conversation's turns, each as a digest of 16 bytes. Paths are
range-partitioned and sorted, so a node's members are neighbours. Only nodes on a path shared
by the rows on both sides of a border between shards lie in several shards: they form the
skeleton, a trie with at most one path per border, which every task is sent. A shard counts
all nodes of its own to the end and hands in partial counts of skeleton nodes; these are
added up by node and then folded from the leaves of the skeleton to its root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.llm.store import parts_for, written

DIGEST = 16
SHARD_BYTES = 8 << 20
# Ids in one piece of a skeleton node's list of ends.
PIECE = 1024
WORD = r"[^\x20\x09-\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()

FINISHED, PARTIAL, ENDS = 0, 1, 2
FOUND = (
    "kind int, node long, conv_id long, depth long, parent_conv_id long, parent_node long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, shard long, piece long, content string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def original(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each a digest of role and text and the number of words.

    Turns are ordered by turn, a missing one first, then by digest. Rows without a conv_id
    belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    turn = F.struct(F.col("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    return turns.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )


def rebuilt(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % group.

    h is crc32(c in decimal) % heads; all turns are taken if there are fewer, none if that
    conversation is absent. Its own turns after the first h follow.
    """
    bases = conversations.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(bases, "base", "left")
    own = F.slice("turns", h + 1, F.size("turns"))
    head = F.slice("head", F.lit(1), h)
    return joined.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(head, own)).alias("turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (the digests of its turns end to end), words (of each turn)."""
    def of(name: str) -> Column:
        return F.transform("turns", lambda x: x[name])

    return conversations.select("conv_id", F.unhex(F.array_join(of("digest"), "")).alias("path"), of("words").alias("words"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of leading turns that two paths have in common."""
    n = min(len(a), len(b)) // DIGEST * DIGEST
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return (int(differ[0]) if len(differ) else n) // DIGEST


def splitters(ordered: DataFrame) -> list[bytes]:
    """For each border between shards the path that the rows on both sides share; distinct ones."""
    borders = ordered.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    borders = borders.select("first", F.lag("last").over(Window.orderBy("shard")).alias("before")).where("before IS NOT NULL")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [a[: DIGEST * shared_turns(a, b)] for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shared, pa.binary())], ["path"])

    return [bytes(row["path"]) for row in borders.mapInArrow(cut, "path binary").distinct().collect()]


class Skeleton:
    """The trie of splitter paths; the root is node 0 and parents come before their children."""

    def __init__(self, paths: list[bytes]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path in sorted(paths):
            node = 0
            for at in range(0, len(path), DIGEST):
                key = (node, path[at: at + DIGEST])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]
        self.inner = {node for node, _ in self.child}


class _Level:
    """The nodes of one depth in a shard, in order of paths."""

    def __init__(self, first: np.ndarray, n_convs: np.ndarray, conv_id: np.ndarray, ends: np.ndarray, words: np.ndarray, parent: np.ndarray, node: np.ndarray):
        self.first, self.n_convs, self.conv_id, self.ends, self.words, self.parent, self.node = first, n_convs, conv_id, ends, words, parent, node
        self.n_children, self.n_leaves, self.saved = (np.zeros(len(first), np.int64) for _ in range(3))

    def close(self) -> None:
        """Complete the nodes of this shard alone, whose children have been added."""
        own = self.node < 0
        self.n_leaves[own & (self.n_children == 0)] = 1
        self.saved[own] += (self.n_convs[own] - 1) * self.words[own]


def levels(conv_id: np.ndarray, digests: np.ndarray, offsets: np.ndarray, words: np.ndarray, skeleton: Skeleton) -> list[_Level]:
    """All nodes of a sorted shard, depth by depth, with the counts that its rows give."""
    n, lengths = len(conv_id), np.diff(offsets)
    shared = np.zeros(n, np.int64)
    same, depth = np.arange(1, n), 0
    while len(same):
        same = same[np.minimum(lengths[same], lengths[same - 1]) > depth]
        same = same[(digests[offsets[same] + depth] == digests[offsets[same - 1] + depth]).all(axis=1)]
        depth += 1
        shared[same] = depth

    rows, at = np.arange(n), np.zeros(n, np.int64)
    root = np.zeros(1, np.int64)
    found = [_Level(root, root + n, conv_id.min(keepdims=True), root + (lengths == 0).sum(), root, root - 1, root)]
    depth = 1
    while len(rows := rows[lengths[rows] >= depth]):
        head = shared[rows] < depth
        heads = np.flatnonzero(head)
        first = rows[heads]
        parent = at[first]
        node = np.full(len(first), -1, np.int64)
        above = found[-1].node[parent]
        for i in np.flatnonzero(np.isin(above, list(skeleton.inner))).tolist():
            node[i] = skeleton.child.get((int(above[i]), digests[offsets[first[i]] + depth - 1].tobytes()), -1)
        at[rows] = np.cumsum(head) - 1
        found.append(_Level(
            first, np.diff(np.append(heads, len(rows))), np.minimum.reduceat(conv_id[rows], heads),
            np.add.reduceat((lengths[rows] == depth).astype(np.int64), heads), words[offsets[first] + depth - 1], parent, node,
        ))
        depth += 1

    for above, level in zip(found[-2::-1], found[:0:-1]):
        level.close()
        own = level.node < 0
        np.add.at(above.n_children, level.parent[own], 1)
        np.add.at(above.n_leaves, level.parent[own], level.n_leaves[own])
        np.add.at(above.saved, level.parent[own], level.saved[own])
    return found


def _columns(n: int, **values) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "content": pa.string()}
    names = [field.split()[0] for field in FOUND.split(", ")]
    arrays = []
    for name in names:
        value, kind = values.get(name), kinds.get(name, pa.int64())
        if value is None:
            arrays.append(pa.nulls(n, kind))
        elif isinstance(value, int):
            arrays.append(pa.array(np.full(n, value), kind))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, names)


def decimal(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def counted(shard: int, conv_id: np.ndarray, digests: np.ndarray, offsets: np.ndarray, words: np.ndarray, skeleton: Skeleton) -> Iterator[pa.RecordBatch]:
    """Finished nodes of a sorted shard, partial counts of skeleton nodes, and pieces of their ends."""
    found = levels(conv_id, digests, offsets, words, skeleton)
    for depth, level in enumerate(found):
        own = np.flatnonzero(level.node < 0)
        if len(own):
            above = found[depth - 1]
            outer = above.node[level.parent[own]]
            hashes = [
                hashlib.sha256(decimal(conv_id[a: a + k]).encode()).hexdigest() if k else NOTHING
                for a, k in zip(level.first[own].tolist(), level.ends[own].tolist())
            ]
            yield _columns(
                len(own), kind=FINISHED, conv_id=level.conv_id[own], depth=depth,
                parent_conv_id=pa.array(above.conv_id[level.parent[own]], mask=outer >= 0), parent_node=pa.array(outer, mask=outer < 0),
                n_convs=level.n_convs[own], n_children=level.n_children[own], n_leaves=level.n_leaves[own], saved_tokens=level.saved[own], content=hashes,
            )
        part = np.flatnonzero(level.node >= 0)
        if len(part):
            yield _columns(
                len(part), kind=PARTIAL, node=level.node[part], conv_id=level.conv_id[part], n_convs=level.n_convs[part], n_children=level.n_children[part],
                n_leaves=level.n_leaves[part], saved_tokens=level.saved[part], words=level.words[part].astype(np.int64),
            )
        for i in part[level.ends[part] > 0].tolist():
            first, end = int(level.first[i]), int(level.first[i] + level.ends[i])
            pieces = [decimal(conv_id[a: min(a + PIECE, end)]) for a in range(first, end, PIECE)]
            yield _columns(len(pieces), kind=ENDS, node=int(level.node[i]), shard=shard, piece=np.arange(len(pieces)), content=pieces)


def _scanned(ordered: DataFrame, shards: int, skeleton: Skeleton) -> DataFrame:
    sent = ordered.sparkSession.sparkContext.broadcast(skeleton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for part in np.split(np.arange(len(numbers)), np.flatnonzero(np.diff(numbers)) + 1):
                if not len(part):
                    continue
                if int(numbers[part[0]]) != current:
                    if held:
                        yield from finish(current, held)
                    current, held = int(numbers[part[0]]), []
                held.append(batch.slice(int(part[0]), len(part)))
        if held:
            yield from finish(current, held)

    def finish(shard: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        content = b"".join(x.as_py() for x in table["path"])
        lengths = np.fromiter((len(x) for x in table["words"]), np.int64, table.num_rows)
        words = table["words"].combine_chunks().flatten().to_numpy()
        digests = np.frombuffer(content, "<u8").reshape(-1, DIGEST // 8)
        yield from counted(shard, table["conv_id"].to_numpy(), digests, np.concatenate([[0], np.cumsum(lengths)]), words, sent.value)

    dealt = ordered.select("shard", "conv_id", "path", "words").repartitionById(shards, F.col("shard"))
    return dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(scan, FOUND)


def _ends(pieces: DataFrame) -> DataFrame:
    """Hash of each skeleton node's ends, streamed piece by piece in order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            for node, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node != current:
                    if state is not None:
                        yield told(current, state)
                    current, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(content.as_py().encode())
        if state is not None:
            yield told(current, state)

    def told(node: int, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ordered = pieces.select("node", "content", "shard", "piece").repartition("node").sortWithinPartitions("node", "shard", "piece")
    return ordered.mapInArrow(stream, "node long, ends_sha256 string")


def folded(skeleton: Skeleton, parts: list) -> list[tuple]:
    """Skeleton nodes with whole counts: node, conv_id, depth, parent_conv_id, and the four counts.

    ``parts`` are the sums of the shards' partial counts, one row per node.
    """
    rows = {row["node"]: row for row in parts}
    children = {node: row["n_children"] for node, row in rows.items()}
    leaves = {node: row["n_leaves"] for node, row in rows.items()}
    saved = {node: row["saved_tokens"] + (row["n_convs"] - 1) * row["words"] for node, row in rows.items()}
    for node in range(len(skeleton.parent) - 1, -1, -1):
        if node not in rows:
            continue
        if not children[node]:
            leaves[node] = 1
        above = skeleton.parent[node]
        if above >= 0:
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    return [
        (node, row["conv_id"], skeleton.depth[node], rows[skeleton.parent[node]]["conv_id"] if node else None, row["n_convs"], children[node], leaves[node], saved[node])
        for node, row in rows.items()
    ]


def prefix_trie(turns: DataFrame, group: int = 20, heads: int = 4, shards: int | None = None) -> DataFrame:
    """Every node of the trie of rebuilt conversations (see ``rebuilt``).

    ``turns`` has conv_id, turn, role and text; further columns are not read. Result per
    node: conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (over its subtree, members beyond the first times the
    words of the node's last text), ends_sha256 (SHA-256 of the ids of the members that end
    here, ascending in decimal and joined by commas).

    Null roles and texts are empty; rows without a conv_id belong to no conversation and are
    not in the trie; repeated rows are turns of their own; an empty table has no nodes, not
    even a root. Equal paths are split between shards by conv_id, so copies of one
    conversation never fill a task, except that the hash of a node's ends is by its nature
    one pass over its ids, streamed in pieces. A conversation's turns come together in one
    row of 36 bytes a turn, whatever the length of their texts.
    """
    spark = turns.sparkSession
    shards = shards or parts_for(spark, turns.count() * 36, SHARD_BYTES)
    sorted_paths = paths(rebuilt(written(original(turns), "conversations"), group, heads)).repartitionByRange(shards, "path", "conv_id")
    ordered = written(sorted_paths.withColumn("shard", F.spark_partition_id()), "paths")
    count = (ordered.agg(F.max("shard")).first()[0] or 0) + 1
    skeleton = Skeleton(splitters(ordered))
    found = written(_scanned(ordered, count, skeleton), "nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.where(F.col("kind") == PARTIAL).groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), *sums).collect()
    names = ["node", *RESULT[:-1]]
    whole = spark.createDataFrame(folded(skeleton, parts), ", ".join(f"{name} long" for name in names))
    ends = _ends(found.where(F.col("kind") == ENDS))
    top = whole.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))

    above = F.broadcast(whole.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("outer")))
    rest = found.where(F.col("kind") == FINISHED).join(above, "parent_node", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "outer")
    ).withColumnRenamed("content", "ends_sha256")
    return rest.select(*RESULT).unionByName(top.select(*RESULT))
