"""Removal of repeated word passages by fixed-block anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tapflow.llm.scatter import by_part, chunked, firsts, in_order, packed_places, unpacked_places
from tapflow.llm.store import parts_for, text_bytes
from tapflow.llm.text import laid_out, prefix, seeds, spans, window_hashes, word_hashes, words

CHUNK = 1 << 20
PART = 64 << 20


class _Words:
    """Words of the documents of a chunk, in the order of ids, with window hashes."""

    def __init__(self, table: pa.Table):
        self.table = _ordered(table)
        self.data, self.offsets = laid_out(self.table.column("text"))
        self.starts, self.ends, self.first = words(self.data, self.offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return window_hashes(self.hashes, self.first, k)

    def second_hash(self, at: np.ndarray, k: int) -> np.ndarray:
        """A hash of the windows that is independent of their first one."""
        again = (self.hashes ^ seeds(1, 21)[0]) * seeds(1, 22)[0] | np.uint64(1)
        again ^= again >> np.uint64(31)
        return spans(prefix(again), at, at + k)


def _ordered(table: pa.Table) -> pa.Table:
    """Documents by id; rows that repeat an id by text."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _owner(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _packets(chunk, hashes, places, owner, parts, kind, flags=None) -> pa.Table:
    order, bounds = by_part(owner, parts)
    columns = {"part": [], "chunk": [], "hashes": [], "flags": [], "places": []}
    for part in np.flatnonzero(np.diff(bounds)):
        mine = order[bounds[part]: bounds[part + 1]]
        columns["part"].append(int(part))
        columns["chunk"].append(chunk)
        columns["hashes"].append(hashes[mine].astype(kind).tobytes())
        columns["flags"].append(b"" if flags is None else np.packbits(flags[mine]).tobytes())
        columns["places"].append(packed_places(places[mine]))
    return pa.table(columns, schema=_PACKET)


_PACKET = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("flags", pa.binary()), ("places", pa.binary()),
])
_PACKET_SQL = "part int, chunk long, hashes binary, flags binary, places binary"
_REPLY = pa.schema([("chunk", pa.int64()), ("places", pa.binary())])


def _replies(table: pa.Table, chosen: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """Places of the chosen entries, one row per packet that has any."""
    chunks, places = [], []
    at = 0
    for row, size in enumerate(sizes):
        mine = chosen[at: at + size]
        at += size
        if mine.any():
            chunks.append(table.column("chunk")[row].as_py())
            places.append(packed_places(unpacked_places(table.column("places")[row].as_py())[mine]))
    return pa.table({"chunk": chunks, "places": places}, schema=_REPLY)


def _replied(table: pa.Table, n: int) -> np.ndarray:
    """Marks of the places named by the replies to one chunk."""
    marks = np.zeros(n, bool)
    for body in table.column("places").to_pylist():
        marks[unpacked_places(body)] = True
    return marks


def _anchor_packets(block: int, parts: int):
    """Every rolling block of a chunk, once per hash, flagged where it is a reference block."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunk = _Words(table)
        hashes, at = chunk.windows(block)
        # reference blocks don't overlap: they start at every block-th word of a document
        aligned = (at - np.repeat(chunk.first[:-1], np.diff(chunk.first))[at]) % block == 0
        order, head, group = firsts(hashes)
        any_aligned = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        any_aligned[group[aligned[order]]] = True
        repeated = np.bincount(group) > 1 if len(group) else any_aligned
        sent = order[head]
        by_place = np.argsort(sent)
        sent = sent[by_place]
        # two flags an entry: is one of them a reference block, do several stand in this chunk
        flags = np.stack([any_aligned[by_place], repeated[by_place]], axis=1)
        return _packets(key[0].as_py(), hashes[sent], at[sent], _owner(hashes[sent], parts), parts, np.uint32, flags)

    return send


def _anchor_replies(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Entries whose block stands elsewhere too and equals a reference block."""
    bodies = [np.frombuffer(x, np.uint32) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(x) for x in bodies])
    flags = np.concatenate([
        np.unpackbits(np.frombuffer(x, np.uint8), count=2 * n).reshape(-1, 2)
        for x, n in zip(table.column("flags").to_pylist(), sizes)
    ]).astype(bool)
    order, _, group = firsts(np.concatenate(bodies))
    several = (np.bincount(group) > 1) | (np.bincount(group, flags[order, 1]) > 0)
    wanted = several & (np.bincount(group, flags[order, 0]) > 0)
    chosen = np.zeros(len(order), bool)
    chosen[order] = wanted[group]
    return _replies(table, chosen, sizes)


def _candidates(chunk: _Words, replies: pa.Table, block: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the windows that hold an anchored block."""
    hashes, at = chunk.windows(block)
    anchored = _spread(hashes, _replied(replies, len(chunk.hashes))[at])
    marks = np.zeros(len(chunk.hashes) + 1, np.int64)
    marks[at[anchored] + 1] = 1
    total = np.cumsum(np.append(marks, 0))
    hashes, at = chunk.windows(window)
    inside = total[at + window - block + 1] > total[at]
    return hashes[inside], at[inside]


def _spread(hashes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Marks of all entries whose hash has a marked entry."""
    return np.isin(hashes, hashes[marked]) if marked.any() else marked


def _window_packets(block: int, window: int, parts: int):
    """The first of equal candidate windows of each chunk, with a hash of 64 bits and its owner's bits.

    The others are repeats already and travel as places without hashes.
    """

    def send(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _PACKET.empty_table()
        chunk = _Words(table)
        hashes, at = _candidates(chunk, replies, block, window)
        order, head, _ = firsts(hashes)
        sent, later = np.sort(order[head]), np.sort(order[~head])
        owner = _owner(chunk.second_hash(at[sent], window), parts)
        number = key[0].as_py()
        found = _packets(number, hashes[sent], at[sent], owner, parts, np.uint64)
        if not len(later):
            return found
        known = {"part": [number % parts], "chunk": [number], "hashes": [None], "flags": [None], "places": [packed_places(at[later])]}
        return pa.concat_tables([found, pa.table(known, schema=_PACKET)])

    return send


def _window_replies(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Entries whose window also starts in an earlier chunk, and the repeats known before."""
    is_known = pc.is_null(table.column("hashes"))
    known = table.filter(is_known).select(["chunk", "places"])
    table = in_order(table.filter(pc.invert(is_known)), "chunk")
    if not table.num_rows:
        return known
    bodies = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    order, head, _ = firsts(np.concatenate(bodies))
    later = np.zeros(len(order), bool)
    later[order] = ~head
    return pa.concat_tables([_replies(table, later, np.array([len(x) for x in bodies])), known])


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string()),
])
_RESULT_SQL = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept_text string"


def _cut(window: int):
    """Remove the words that repeated windows cover."""

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _RESULT.empty_table()
        chunk = _Words(table)
        repeated = np.flatnonzero(_replied(replies, len(chunk.hashes)))
        cover = np.zeros(len(chunk.hashes) + 1, np.int64)
        cover[repeated] += 1
        cover[repeated + window] -= 1
        return _results(chunk, np.cumsum(cover)[:-1] > 0)

    return cut


def _results(chunk: _Words, removed: np.ndarray) -> pa.Table:
    content = chunk.data.tobytes()
    spans_out, texts = [], []
    for first, end in zip(chunk.first[:-1], chunk.first[1:]):
        mine = removed[first:end]
        if not mine.any():
            spans_out.append([])
            kept = range(first, end)
        else:
            edge = np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))
            spans_out.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
            kept = first + np.flatnonzero(~mine)
        starts, ends = chunk.starts, chunk.ends
        texts.append(b" ".join([content[starts[i]: ends[i]] for i in kept]).decode("utf-8", "replace"))
    return pa.table({
        "doc_id": chunk.table.column("doc_id"), "n_words": np.diff(chunk.first), "spans": spans_out, "kept_text": texts,
    }, schema=_RESULT)


def remove_repeats(docs: DataFrame, window: int = 20, block: int = 10, text: str = "text", chunk: int = CHUNK, part: int = PART) -> DataFrame:
    """Remove every word covered by a ``window`` of words that also starts earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document; windows never
    cross documents and are judged on the input.

    1. Reference blocks of ``block`` words that don't overlap are indexed; every rolling
       block probes them. As 2 * block - 1 <= window, each repeat of a window holds a whole
       reference block of either copy. Both meet in the part that owns their hash, which
       answers with the blocks that stand in several places (a chance agreement of short
       hashes only adds candidates).
    2. Hits are extended: each window around an anchored block is compared, by a hash of 64
       bits and the independent bits that choose its part, with all other such windows; all
       but the first in the corpus are repeats, and runs of them are the maximal repeats.

    The text is shuffled once and used three times. Result: doc_id, n_words, spans of removed
    words (half-open, maximal), kept_text (kept words joined by a space). Null or empty texts
    have no words; rows with a null doc_id come back whole; rows that repeat a doc_id are
    taken one after the other in the order of their texts.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole reference block: 2 * block - 1 <= window")
    size = text_bytes(docs, text)
    parts = parts_for(docs.sparkSession, size, part)
    dealt = chunked(docs, size, chunk, text=text)
    by_chunk = dealt.groupBy("chunk")
    anchors = by_chunk.applyInArrow(_anchor_packets(block, parts), _PACKET_SQL)
    anchored = anchors.groupBy("part").applyInArrow(_anchor_replies, "chunk long, places binary")
    found = by_chunk.cogroup(anchored.groupBy("chunk")).applyInArrow(_window_packets(block, window, parts), _PACKET_SQL)
    later = found.groupBy("part").applyInArrow(_window_replies, "chunk long, places binary")
    cut = by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(_cut(window), _RESULT_SQL)
    unnamed = docs.where("doc_id IS NULL").select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut.unionByName(_whole(unnamed))


def _whole(docs: DataFrame) -> DataFrame:
    found = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    return docs.select(
        "doc_id", F.size(found).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), F.array_join(found, " ").alias("kept_text"),
    )
