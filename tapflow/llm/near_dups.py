"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapflow.llm.components import components
from tapflow.llm.store import written
from tapflow.llm.text import LOWER, chunks, laid_out, seeds, spans, prefix, window_hashes, word_hashes, words

HASHES = 128
ROWS = 4
BITS = 4
# Shingles that a tile of an unsettled bucket may hold.
TILE = 1 << 18
# Standard deviations by which an estimate may fall short of the threshold.
SLACK = 5.0


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a chunk."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashed = word_hashes(data, starts, ends)
    runs, at = window_hashes(hashed, first, size)
    bounds = np.searchsorted(at, first)
    counts = np.diff(first)
    sets = [np.unique(runs[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = spans(prefix(hashed), first[short], first[short + 1])
        for row, value in zip(short, whole):
            sets[row] = np.array([value], np.uint64)
    return sets


class MinHash:
    """Minima of a shingle set under ``n`` fixed permutations of 32-bit values."""

    def __init__(self, n: int, rows: int, bits: int):
        drawn = seeds(2 * n, 5)
        self.factor = (drawn[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.shift = (drawn[n:] >> np.uint64(32)).astype(np.uint32)
        self.n, self.rows, self.bits = n, rows, bits
        self.salt = seeds(n // rows, 6)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        values = (shingles >> np.uint64(17)).astype(np.uint32)
        least = np.full(self.n, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(values), 2048):
            drawn = values[None, at: at + 2048] * self.factor[:, None]
            drawn += self.shift[:, None]
            drawn ^= drawn >> np.uint32(15)
            drawn *= np.uint32(0x2C1B3C6D)
            drawn ^= drawn >> np.uint32(12)
            np.minimum(least, drawn.min(axis=1), out=least)
        return least

    def packed(self, minima: np.ndarray) -> np.ndarray:
        """The low ``bits`` bits of every (scrambled) minimum, packed side by side into 64-bit values."""
        low = (minima & np.uint32((1 << self.bits) - 1)).astype(np.uint64).reshape(-1, 64 // self.bits)
        places = np.arange(0, 64, self.bits, dtype=np.uint64)
        return np.bitwise_or.reduce(low << places, axis=1).view(np.int64)

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band of ``rows`` minima."""
        grouped = minima.reshape(-1, self.rows).astype(np.uint64)
        key = self.salt.copy()
        for row in range(self.rows):
            key = (key ^ grouped[:, row]) * np.uint64(0x9FB21C651E98DF25)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)


def signatures(docs: DataFrame, size: int, hashes: int, rows: int, bits: int, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, a digest of the shingle set, packed low bits, band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = MinHash(hashes, rows, bits)
        for batch in batches:
            data, offsets = laid_out(batch.column(1))
            for first, end, part, places in chunks(data, offsets):
                counts, digests, packs, keys = [], [], [], []
                for shingles in shingle_sets(part, places, size):
                    counts.append(len(shingles))
                    if not len(shingles):
                        digests.append(None), packs.append(None), keys.append(None)
                        continue
                    least = family.minima(shingles)
                    digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                    packs.append(family.packed(least))
                    keys.append(family.bands(least))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, end - first), pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()), pa.array(packs, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64())),
                ], ["doc_id", "n_shingles", "digest", "sketch", "bands"])

    return docs.select("doc_id", text).mapInArrow(
        sign, "doc_id long, n_shingles long, digest binary, sketch array<long>, bands array<long>"
    )


def full_sets(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """doc_id and its sorted shingle hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = laid_out(batch.column(1))
            for first, end, part, places in chunks(data, offsets):
                sets = [x.view(np.int64) for x in shingle_sets(part, places, size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"]
                )

    return docs.select("doc_id", text).mapInArrow(build, "doc_id long, shingles array<long>")


def group_mask(bits: int) -> int:
    """A set bit at the foot of every group of ``bits`` bits, as a signed 64-bit value."""
    mask = sum(1 << at for at in range(0, 64, bits))
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def corrected(agree, hashes: int, bits: int):
    """Similarity from the number of agreeing groups, less agreement by chance of 2**-bits."""
    chance = 2.0 ** -bits
    return (agree / float(hashes) - chance) / (1 - chance)


def least_estimate(threshold: float, hashes: int, bits: int) -> float:
    """An estimate that true pairs at ``threshold`` miss with a chance of about one in a million."""
    chance = 2.0 ** -bits
    agree = chance + (1 - chance) * threshold
    return threshold - SLACK * (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)


def estimate(left: str, right: str, hashes: int, bits: int):
    """Estimated similarity of two packed sketches by bit counts."""
    differing = F.lit(0)
    for lane in range(hashes * bits // 64):
        apart = F.col(left)[lane].bitwiseXOR(F.col(right)[lane])
        folded = apart
        for step in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(apart, step))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(group_mask(bits))))
    return corrected(F.lit(hashes) - differing, hashes, bits)


def _tile_links(nodes: list[int], roots: list[int], sets: list[np.ndarray], part: int, whole: int) -> list[tuple[int, int]]:
    """Links that join different components of a tile; a forest over them.

    Every pair of different components has a member outside the largest component. Each such
    member is held against all sets at once: its shingles are marked, and the marks are
    counted set by set.
    """
    parent = {x: x for x in roots}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(x) for x in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    distinct, number = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(distinct), np.int32)
    names, counts = np.unique(roots, return_counts=True)
    largest, found = names[np.argmax(counts)], []
    for a in np.flatnonzero(np.array(roots) != largest):
        mine = number[bounds[a]: bounds[a + 1]]
        marked[mine] = 1
        common = np.add.reduceat(marked[number], bounds[:-1])
        marked[mine] = 0
        for b in np.flatnonzero(whole * common >= part * (sizes + sizes[a] - common)):
            if root(roots[a]) != root(roots[b]):
                parent[root(roots[a])] = root(roots[b])
                found.append((nodes[a], nodes[b]))
    return found


def _as_links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links; without any they stay, which saves the driver the rounds' plans."""
    return roots if links.isEmpty() else components(_as_links(roots).union(links))


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends are in different components so far."""
    for end in ("a", "b"):
        of_end = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(of_end, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs.where("root_a != root_b").select("a", "b")


def _confirmed(docs: DataFrame, pairs: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach part / whole, written to the shared folder."""
    pairs = written(pairs.select("a", "b"), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _wanted_sets(docs, ids, size)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    found = pairs.join(right, "b").join(left, "a").where(common * whole >= union * part).select("a", "b")
    return written(found, "links")


def _wanted_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    return full_sets(docs.join(ids, "doc_id", "left_semi"), size)


def near_duplicates(
    docs: DataFrame, part: int = 75, whole: int = 100, size: int = 5, hashes: int = HASHES,
    rows: int = ROWS, bits: int = BITS, text: str = "text",
) -> DataFrame:
    """Components of documents whose sets of ``size``-word shingles agree to part / whole.

    Words are lower-cased (A-Z). Each set gets ``hashes`` minima; bands of ``rows`` minima
    make candidates, only the low ``bits`` bits are kept to estimate similarity by bit
    counts, and candidates are confirmed on full sets. A pair at the threshold is missed by
    all bands with a chance of (1 - 0.75**rows)**(hashes / rows), 5 in a million at 4 of 128.

    Equal sets are one class from the start. In a band bucket every class is compared with
    the smallest one, which settles a group of copies in as many comparisons as it has
    members. Buckets that still hold several components after that are compared in full,
    in tiles of ``TILE`` classes with their sets, skipping pairs already in one component.

    Result: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id,
    kept. Null or empty texts have no shingles and are linked with nothing. A row without a
    doc_id takes the component of an equal set that has one, and is then not kept; without
    such a set its component is null and it is kept. Rows repeating a doc_id count as one
    document.
    """
    docs = docs.select("doc_id", F.col(text).alias("text"))
    signed = written(signatures(docs, size, hashes, rows, bits), "signatures")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands"),
    ), "classes")
    banded = classes.select("rep", F.posexplode("bands").alias("band", "key")).select(
        "rep", F.xxhash64("band", "key").alias("key")
    )
    buckets = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = written(banded.join(buckets, "key"), "members")

    least = least_estimate(part / whole, hashes, bits)
    about = classes.select("rep", "n", "sketch")
    to_hub = members.where("rep != hub").select("hub", "rep").distinct()
    close = (
        to_hub.join(about.select("rep", F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b")), "rep")
        .join(about.select(F.col("rep").alias("hub"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a")), "hub")
        .where(F.least("n_a", "n_b") * whole >= F.greatest("n_a", "n_b") * part)
        .select(F.col("hub").alias("a"), F.col("rep").alias("b"), estimate("sketch_a", "sketch_b", hashes, bits).alias("about"))
        .where(F.col("about") >= least)
    )
    close = written(close, "close")
    best = close.groupBy("b").agg(F.max_by("a", F.struct("about", "a")).alias("a"))
    stars = components(_confirmed(docs, best, size, part, whole))
    rest = _across(close.select("a", "b"), stars).join(best, ["a", "b"], "left_anti")
    stars = _extended(stars, _confirmed(docs, rest, size, part, whole))
    crossed = written(_within_tiles(docs, _unsettled(members, stars), about, part, whole, size), "crossed")
    roots = _extended(stars, crossed)

    class_of = classes.select("digest", F.col("rep").alias("class_id"))
    return (
        signed.select("doc_id", "n_shingles", "digest").join(class_of, "digest", "left")
        .join(roots.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("root", "class_id", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (key, rep, n, root) of buckets of three or more that hold several components.

    Buckets with the same members are kept once.
    """
    rooted = members.where("n > 2").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("root", "rep").alias("root")
    )
    several = rooted.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("print"),
    ).where("low != high")
    once = several.groupBy("n", "print").agg(F.min("key").alias("key"))
    return rooted.join(once.select("key", "n"), "key")


def _within_tiles(docs: DataFrame, mixed: DataFrame, about: DataFrame, part: int, whole: int, size: int) -> DataFrame:
    """Confirmed links across components inside the unsettled buckets."""
    mixed = written(mixed.join(about.select("rep", F.col("n").alias("size")), "rep"), "mixed")
    sets = _wanted_sets(docs, mixed.select(F.col("rep").alias("doc_id")).distinct(), size)
    tiles = mixed.groupBy("key").agg(F.ceil(F.sum("size") / TILE).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("tiles")).cast("int")
    placed = mixed.join(tiles, "key").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    ).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "root")
    filled = placed.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select("key", "i", "j", "rep", "root", "shingles")
    by_tile = filled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, roots, sets = None, [], [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(3))))
            reps, tops = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            column = batch.column(5)
            bounds, shingles = np.asarray(column.offsets), np.asarray(column.values)
            for at, key in enumerate(keys):
                if key != current:
                    yield from linked(nodes, roots, sets)
                    current, nodes, roots, sets = key, [], [], []
                nodes.append(reps[at])
                roots.append(tops[at])
                sets.append(shingles[bounds[at]: bounds[at + 1]].copy())
        yield from linked(nodes, roots, sets)

    def linked(nodes: list[int], roots: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        links = _tile_links(nodes, roots, sets, part, whole) if len(set(roots)) > 1 else []
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return by_tile.mapInArrow(compare, "a long, b long")
