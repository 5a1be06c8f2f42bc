"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tapflow.llm.store import written
from tapflow.llm.text import chunks, laid_out, prefix, spans, window_hashes, word_hashes, words

# Words of the shortest tile, which is also the seed.
SHORTEST = 5
# Share of an item's words that tiles must cover.
COVERED = 0.5
# Bits of the seed filter for each seed, and at most (16 MB); a fuller filter only passes more.
SEED_BITS = 16
MOST_BITS = 1 << 27
PIECE_BITS = 1 << 16

# Anything but letters, digits and bytes of longer characters parts words.
_APART = np.ones(256, bool)
_APART[48:58] = _APART[65:91] = _APART[97:123] = _APART[128:] = False


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of lower-cased texts, and the first word of each text (plus the total)."""
    column = pc.utf8_lower(pc.fill_null(column, ""))
    data, offsets = laid_out(column)
    hashes, firsts, total = [], [np.zeros(1, np.int64)], 0
    for _, _, part, places in chunks(data, offsets):
        starts, ends, first = words(part, places, _APART)
        hashes.append(word_hashes(part, starts, ends))
        firsts.append(first[1:] + total)
        total += len(starts)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(firsts)


def greedy_tiles(text: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (place in text, place in item, length): repeatedly the longest matches of unmarked words.

    Running Karp-Rabin: windows of the current search length over unmarked words of both
    sides are matched by rolling hash and extended; a match more than twice as long restarts
    the search at its length, otherwise matches are marked longest first (then by place) as
    far as still unmarked, and the search length is halved down to ``shortest``.
    """
    of_text, of_item = prefix(text), prefix(item)
    free_text, free_item = np.ones(len(text), bool), np.ones(len(item), bool)
    tiles, length = [], max(shortest, min(20, len(item)))
    while True:
        matches = _matches(text, item, of_text, of_item, free_text, free_item, length)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        matches.sort(key=lambda m: (-m[2], m[0], m[1]))
        again = False
        for a, b, size in matches:
            if free_text[a: a + size].all() and free_item[b: b + size].all():
                free_text[a: a + size] = free_item[b: b + size] = False
                tiles.append((a, b, size))
            else:
                again = True  # what is left of an occluded match may still be long enough
        if again:
            continue
        if length == shortest:
            return tiles
        length = max(shortest, length // 2)


def _open_windows(free: np.ndarray, length: int) -> np.ndarray:
    if len(free) < length:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(total[length:] - total[:-length] == length)


def _matches(text, item, of_text, of_item, free_text, free_item, length: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``length`` unmarked words."""
    at_text, at_item = _open_windows(free_text, length), _open_windows(free_item, length)
    if not len(at_text) or not len(at_item):
        return []
    a, b = spans(of_text, at_text, at_text + length), spans(of_item, at_item, at_item + length)
    order = np.argsort(b, kind="stable")
    hit = np.isin(a, b)
    found = []
    at_text, a = at_text[hit], a[hit]
    low, high = np.searchsorted(b[order], a), np.searchsorted(b[order], a, "right")
    for place, first, end in zip(at_text, low, high):
        for other in at_item[order[first:end]]:
            i, j = int(place), int(other)
            if i and j and free_text[i - 1] and free_item[j - 1] and text[i - 1] == item[j - 1]:
                continue  # inside a match that starts earlier
            size = length
            while i + size < len(text) and j + size < len(item) and free_text[i + size] and free_item[j + size] and text[i + size] == item[j + size]:
                size += 1
            found.append((i, j, size))
    return found


def seeds_of(rows: DataFrame, key: str, shortest: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """(key, seed): distinct hashes of every ``shortest`` consecutive words of each row, those in
    the filter where one is given."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                hashed, first = tokens(part.column(1))
                runs, place = window_hashes(hashed, first, shortest)
                if bitmap is not None:
                    hit = passes(bitmap, runs)
                    runs, place = runs[hit], place[hit]
                row = np.searchsorted(first, place, "right") - 1
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(runs.view(np.int64))], [key, "seed"])

    return rows.select(F.col(key).cast("long").alias(key), "text").mapInArrow(build, f"{key} long, seed long").distinct()


def passes(bitmap: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Which seeds have their bit set."""
    slot = seeds & np.uint64(8 * len(bitmap) - 1)
    return bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1


def seed_filter(index: DataFrame, n: int) -> np.ndarray:
    """A bitmap with the bit of every seed set: a power of two of bits, ``SEED_BITS`` a seed, 16 MB at most."""
    bits = max(PIECE_BITS, min(MOST_BITS, 1 << (SEED_BITS * max(n, 1) - 1).bit_length()))
    slots = index.select(F.col("seed").bitwiseAND(F.lit(bits - 1)).alias("slot")).distinct()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy()
            for piece in np.unique(slot // PIECE_BITS):
                marks = held.setdefault(int(piece), np.zeros(PIECE_BITS, bool))
                marks[slot[slot // PIECE_BITS == piece] % PIECE_BITS] = True
        if held:
            content = [np.packbits(x, bitorder="little").tobytes() for x in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(content)], ["piece", "content"])

    dealt = slots.withColumn("piece", F.floor(F.col("slot") / PIECE_BITS)).repartition("piece").select("slot")
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in dealt.mapInArrow(build, "piece long, content binary").collect():  # 16 MB at most
        at = row["piece"] * PIECE_BITS // 8
        bitmap[at: at + PIECE_BITS // 8] |= np.frombuffer(row["content"], np.uint8)
    return bitmap


def tiled_pairs(docs: DataFrame, items: DataFrame, pairs: DataFrame, shortest: int) -> DataFrame:
    """Tiles of each pair: doc_id, item_id, n_words (of the item), covered, tiles."""
    kind = "array<struct<doc:long,item:long,size:long>>"

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                text, first = tokens(part.column(2))
                item, begin = tokens(part.column(3))
                found = [
                    greedy_tiles(text[first[i]: first[i + 1]], item[begin[i]: begin[i + 1]], shortest) for i in range(part.num_rows)
                ]
                tiles = [[{"doc": a, "item": b, "size": n} for a, b, n in sorted(x)] for x in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(np.diff(begin)),
                    pa.array([sum(n for _, _, n in x) for x in found], pa.int64()),
                    pa.array(tiles, pa.list_(pa.struct([("doc", pa.int64()), ("item", pa.int64()), ("size", pa.int64())]))),
                ], ["doc_id", "item_id", "n_words", "covered", "tiles"])

    known = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    joined = pairs.join(docs.select("doc_id", "text"), "doc_id").join(known, "item_id")
    return joined.select("doc_id", "item_id", "text", "item_text").mapInArrow(
        tile, f"doc_id long, item_id long, n_words long, covered long, tiles {kind}"
    )


def contaminated(
    docs: DataFrame, items: DataFrame, shortest: int = SHORTEST, covered: float = COVERED,
) -> DataFrame:
    """Pairs of documents and benchmark items whose tiles cover at least ``covered`` of the item.

    Words are lower-cased runs of letters, digits and longer characters. A document is a
    candidate for an item when they share ``shortest`` consecutive words. Each candidate is
    tiled greedily, so passages in another order, or with other text between them, count in
    full. Seeds of documents are joined with those of items; a bitmap of the items' seeds,
    16 MB at most, spares the join nearly all others. Items with fewer than ``shortest`` words,
    null or empty texts, and null ids match nothing. Repeated rows of an id: the pair is
    returned once, with the largest cover.

    Result: doc_id, item_id, n_words, covered, tiles (doc word, item word, size).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    index = written(seeds_of(items, "item_id", shortest), "seeds")
    bitmap = seed_filter(index, index.count())
    pairs = written(seeds_of(docs, "doc_id", shortest, bitmap).join(index, "seed").select("doc_id", "item_id").distinct(), "pairs")
    found = tiled_pairs(docs, items, pairs, shortest).where(F.col("covered") >= F.col("n_words") * F.lit(covered))
    best = F.max_by(F.struct("n_words", "covered", "tiles"), F.struct("covered", "n_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def flagged(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Every document with its number of items, largest share covered, and whether it is contaminated."""
    by_doc = contaminated(docs, items, **options).groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.max(F.col("covered") / F.col("n_words")).alias("share"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    return docs.select("doc_id").join(by_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("share", F.lit(0.0)).alias("share"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.col("n_items").isNotNull().alias("contaminated"),
    )
