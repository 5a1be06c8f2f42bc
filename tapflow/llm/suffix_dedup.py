"""Removal of repeated byte strings by hash-compared suffix sorting around anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tapflow.llm.scatter import by_part, chunked, firsts, in_order, packed_places, unpacked_places
from tapflow.llm.store import parts_for, text_bytes
from tapflow.llm.text import byte_prefix, laid_out, mix, prefix, seeds, spans

CHUNK = 1 << 20
PART = 64 << 20
GRAM = 20
# Buckets with more contexts than this are compared window by window over all parts.
LARGE_BUCKET = 20_000

# kinds of packets and replies
CONTEXT, KEY, ROWS, WINDOW, FULL, START = range(6)

_PACKET = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()),
    ("hashes", pa.binary()), ("extra", pa.binary()), ("places", pa.binary()),
])
_PACKET_SQL = "part int, chunk long, kind int, hashes binary, extra binary, places binary"
_REPLY = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("places", pa.binary())])
_REPLY_SQL = "chunk long, kind int, places binary"

_GRAM_VALUE = (seeds(256, 31) >> np.uint64(32)).astype(np.uint32)
_SECOND_VALUE = seeds(256, 32)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Positive 32-bit hash of the ``GRAM`` bytes from each position, by doubling."""
    base = 0x9E3779B1

    def joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
        return left * np.uint32(pow(base, size, 1 << 32)) + right

    one = _GRAM_VALUE[data]
    two = joined(one[:-1], one[1:], 1)
    four = joined(two[:-2], two[2:], 2)
    eight = joined(four[:-4], four[4:], 4)
    sixteen = joined(eight[:-8], eight[8:], 8)
    out = joined(sixteen[:-4], four[16:], 4)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out | np.uint32(1)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Best of every ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Positions whose gram is the smallest of some window inside one text (all of the ties).

    They depend on the content of the window alone, so both copies of a repeated window
    have an anchor at the same place in it.
    """
    width = window - GRAM + 1
    if len(data) < window:
        return np.zeros(0, np.int64)
    hashes = gram_hashes(data)
    least = _sliding(hashes, width, np.minimum)
    edges = np.zeros(len(data) + 1, np.int32)
    long_enough = np.diff(offsets) >= window
    np.add.at(edges, offsets[:-1][long_enough], 1)
    np.subtract.at(edges, offsets[1:][long_enough] - window + 1, 1)
    least[np.cumsum(edges)[: len(least)] == 0] = 0
    around = np.zeros(len(least) + 2 * (width - 1), np.uint32)
    around[width - 1: width - 1 + len(least)] = least
    return np.flatnonzero(_sliding(around, width, np.maximum) == hashes)


class _Bytes:
    """Bytes of the documents of a chunk, in the order of ids, with anchors and their contexts."""

    def __init__(self, table: pa.Table, window: int, anchored: bool = True):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.data, self.offsets = laid_out(self.table.column("text"))
        self.window = window
        if anchored:
            self.at = anchors(self.data, self.offsets, window)
            self.left, self.right = self.reach(self.at)

    def reach(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of context to the left and from the anchor on, inside its document."""
        row = np.searchsorted(self.offsets, at, "right") - 1
        left = np.minimum(at - self.offsets[row], self.window - GRAM)
        return left, np.minimum(self.offsets[row + 1] - at, self.window)

    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each anchor's gram, and of its whole context."""
        self.sums = byte_prefix(self.data)
        keys = spans(self.sums, self.at, self.at + GRAM)
        whole = spans(self.sums, self.at - self.left, self.at + self.right)
        return keys, mix(whole ^ (self.left.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))

    def contexts(self, chosen: np.ndarray) -> np.ndarray:
        """One row per anchor: reach left, reach right, left bytes read backwards, right bytes."""
        side = self.window - GRAM
        out = np.zeros((len(chosen), 2 + side + self.window), np.uint8)
        padded = np.concatenate([np.zeros(side, np.uint8), self.data, np.zeros(self.window, np.uint8)])
        at = self.at[chosen] + side
        left, right = self.left[chosen], self.right[chosen]
        out[:, 0], out[:, 1] = left, right
        back = np.arange(side)
        out[:, 2: 2 + side] = np.where(back < left[:, None], padded[at[:, None] - 1 - back], 0)
        ahead = np.arange(self.window)
        out[:, 2 + side:] = np.where(ahead < right[:, None], padded[at[:, None] + ahead], 0)
        return out


def _packets(chunk: int, kind: int, hashes, places, owner, parts: int, extra=None) -> pa.Table:
    order, bounds = by_part(owner, parts)
    columns = {name: [] for name in _PACKET.names}
    for part in np.flatnonzero(np.diff(bounds)):
        mine = order[bounds[part]: bounds[part + 1]]
        columns["part"].append(int(part))
        columns["chunk"].append(chunk)
        columns["kind"].append(kind)
        columns["hashes"].append(hashes[mine].tobytes())
        columns["extra"].append(None if extra is None else np.ascontiguousarray(extra[mine]).tobytes())
        columns["places"].append(packed_places(places[mine]))
    return pa.table(columns, schema=_PACKET)


def _known(chunk: int, kind: int, places: np.ndarray, parts: int) -> pa.Table:
    """Places that need no answer; they pass through a part on their way to the next step."""
    rows = [] if not len(places) else [packed_places(np.unique(places))]
    return pa.table({
        "part": [chunk % parts] * len(rows), "chunk": [chunk] * len(rows), "kind": [kind] * len(rows),
        "hashes": [None] * len(rows), "extra": [None] * len(rows), "places": rows,
    }, schema=_PACKET)


def _owner(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def _replies(table: pa.Table, sizes: np.ndarray, answers: dict[int, np.ndarray]) -> pa.Table:
    """For each kind, the places of the chosen entries of each packet."""
    columns = {name: [] for name in _REPLY.names}
    ends = np.cumsum(sizes)
    chunks, bodies = table.column("chunk").to_pylist(), table.column("places").to_pylist()
    for row, end in enumerate(ends):
        for kind, chosen in answers.items():
            mine = chosen[end - sizes[row]: end]
            if mine.any():
                columns["chunk"].append(chunks[row])
                columns["kind"].append(kind)
                columns["places"].append(packed_places(unpacked_places(bodies[row])[mine]))
    return pa.table(columns, schema=_REPLY)


def _told(replies: pa.Table, kind: int, n: int) -> np.ndarray:
    """Marks of the places of one kind."""
    marks = np.zeros(n, bool)
    for body in replies.filter(pc.equal(replies.column("kind"), kind)).column("places").to_pylist():
        marks[unpacked_places(body)] = True
    return marks


def _anchor_packets(window: int, parts: int):
    """Contexts of a chunk once each to the owner of the context, grams once each to the owner of the gram."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number, chunk = key[0].as_py(), _Bytes(table, window)
        keys, contexts = chunk.hashed()
        order, head, _ = firsts(contexts)
        sent, later = np.sort(order[head]), np.sort(order[~head])
        order, head, group = firsts(keys[sent])
        first = sent[order[head]]
        counts = np.minimum(np.bincount(group), 255) if len(group) else group
        digest = mix(contexts[first] + np.uint64(1))
        hashes = (keys[first] & np.uint64(0xFFFFFFFF)) << np.uint64(32) | digest >> np.uint64(32)
        extra = (digest & np.uint64(0xFF00)).astype(np.uint16) | counts.astype(np.uint16)
        by_place = np.argsort(first)
        first = first[by_place]
        return pa.concat_tables([
            _packets(number, CONTEXT, contexts[sent], chunk.at[sent], _owner(mix(contexts[sent] + np.uint64(7)), parts), parts),
            _packets(number, KEY, hashes[by_place], chunk.at[first], _owner(keys[first], parts), parts, extra[by_place]),
            _known(number, FULL, chunk.at[later], parts),
        ])

    return send


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    return in_order(table.filter(pc.and_(pc.equal(table.column("kind"), kind), pc.is_valid(table.column("hashes")))), "chunk")


def _bodies(table: pa.Table, column: str, kind) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, kind) for x in table.column(column).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, kind), np.array([len(x) for x in parts], np.int64)


def _passed(table: pa.Table) -> pa.Table:
    return table.filter(pc.is_null(table.column("hashes"))).select(_REPLY.names)


def _later(hashes: np.ndarray) -> np.ndarray:
    """Marks of the entries whose hash came before."""
    order, head, _ = firsts(hashes)
    later = np.zeros(len(order), bool)
    later[order] = ~head
    return later


def _anchor_replies(large: int):
    """Contexts seen before; grams that stand in several contexts, and in very many."""

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = [_passed(table)]
        mine = _of_kind(table, CONTEXT)
        hashes, sizes = _bodies(mine, "hashes", np.uint64)
        out.append(_replies(mine, sizes, {FULL: _later(hashes)}))
        mine = _of_kind(table, KEY)
        hashes, sizes = _bodies(mine, "hashes", np.uint64)
        extra, _ = _bodies(mine, "extra", np.uint16)
        if len(hashes):
            order, head, group = firsts(hashes >> np.uint64(32))
            digest = (hashes & np.uint64(0xFFFFFFFF)) << np.uint64(8) | (extra >> 8).astype(np.uint64)
            count = (extra & 255).astype(np.int64)
            other = digest[order] != digest[order[head]][group]
            several = (np.bincount(group, other) > 0) | (np.bincount(group, count[order] > 1) > 0)
            many = np.bincount(group, count[order]) > large
            is_several, is_many = np.zeros(len(order), bool), np.zeros(len(order), bool)
            is_several[order], is_many[order] = (several & ~many)[group], (several & many)[group]
            out.append(_replies(mine, sizes, {ROWS: is_several, WINDOW: is_many}))
        return pa.concat_tables(out)

    return answer


def _context_packets(window: int, parts: int):
    """Contexts in full for the unsettled anchors of a chunk; for those of very large buckets, window hashes."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _PACKET.empty_table()
        number, chunk = key[0].as_py(), _Bytes(table, window)
        keys, contexts = chunk.hashed()
        full = _told(replies, FULL, len(chunk.data) + 1)
        at = chunk.at
        open_ones = ~full[at]
        rows = _told(replies, ROWS, len(chunk.data) + 1)[at]
        chosen = np.flatnonzero(open_ones & np.isin(keys, keys[rows]))
        out = [
            _packets(number, ROWS, keys[chosen], at[chosen], _owner(keys[chosen], parts), parts, chunk.contexts(chosen)),
            _known(number, FULL, np.flatnonzero(full), parts),
        ]
        many = _told(replies, WINDOW, len(chunk.data) + 1)[at]
        chosen = np.flatnonzero(open_ones & np.isin(keys, keys[many])) if many.any() else np.zeros(0, np.int64)
        if len(chosen):
            starts = _window_starts(at[chosen], chunk.left[chosen], chunk.right[chosen], window)
            hashes = spans(chunk.sums, starts, starts + window)
            second = spans(prefix(_SECOND_VALUE[chunk.data]), starts, starts + window)
            order, head, _ = firsts(hashes)
            sent, later = np.sort(order[head]), order[~head]
            out.append(_packets(number, WINDOW, hashes[sent], starts[sent], _owner(second[sent], parts), parts))
            out.append(_known(number, START, starts[later], parts))
        return pa.concat_tables(out)

    return send


def _window_starts(at, left, right, window: int) -> np.ndarray:
    """Starts of all windows inside the contexts."""
    first, last = at - left, at + right - window
    count = np.maximum(last - first + 1, 0)
    base = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.unique(base + np.arange(count.sum()))


def common_prefix(sums: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes i and j by binary search in prefix hashes."""
    low = np.zeros(len(i), np.int64)
    high = np.full(len(i), sums.shape[1] - 1, np.int64)
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = sums[i, middle] == sums[j, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sorted_suffixes(rows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes inside their buckets, and the common prefix of each with the one before.

    ``rows`` holds a suffix a row (0 where it ended), ``bucket`` is increasing. Bottom-up
    mergesort of all buckets at once: an element of a run finds its rank in the neighbouring
    run by binary search, and each comparison finds the common prefix by binary search in
    prefix polynomial hashes. Neighbours are verified byte by byte at the end; should a
    hash have erred, the order comes from the bytes themselves.
    """
    n, width = rows.shape
    sums = np.zeros((n, width + 1), np.uint64)
    factors = seeds(1, 41)[0] | np.uint64(1)
    weight = np.multiply.accumulate(np.full(width, factors, np.uint64))
    np.cumsum(mix(rows.astype(np.uint64) + np.uint64(1)) * weight, axis=1, out=sums[:, 1:])
    ended = np.concatenate([rows, np.zeros((n, 1), rows.dtype)], axis=1)

    def before(i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        shared = common_prefix(sums, i, j)
        a, b = ended[i, shared], ended[j, shared]
        return (a < b) | ((shared == width) & or_equal)

    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    sizes = np.diff(np.append(starts, n))
    start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    inside = np.arange(n) - start
    order = np.arange(n)
    run = 1
    while run < (sizes.max() if n else 0):
        live = np.flatnonzero(size > run)
        place = inside[live]
        other = (place // run ^ 1) * run
        low, high = np.zeros(len(live), np.int64), np.clip(size[live] - other, 0, run)
        is_right = place // run % 2 == 1
        while True:
            going = np.flatnonzero(low < high)
            if not len(going):
                break
            middle = (low[going] + high[going]) >> 1
            probe = order[start[live[going]] + other[going] + middle]
            less = before(probe, order[live[going]], is_right[going])
            low[going] = np.where(less, middle + 1, low[going])
            high[going] = np.where(less, high[going], middle)
        target = start[live] + np.minimum(place // run * run, other) + place % run + low
        moved = order[live]
        order[target] = moved
        run *= 2
    shared = np.zeros(n, np.int64)
    same = np.flatnonzero(np.diff(bucket, prepend=-1) == 0)
    shared[same] = common_prefix(sums, order[same], order[same - 1])
    equal = ended[order[same]] == ended[order[same - 1]]
    exact = np.where(equal[:, :width].all(axis=1), width, np.argmin(equal, axis=1))
    rising = ended[order[same], exact] >= ended[order[same - 1], exact]
    if (exact != shared[same]).any() or not rising.all():
        order = np.lexsort((*rows.T[::-1], bucket))
        equal = ended[order[same]] == ended[order[same - 1]]
        exact = np.where(equal[:, :width].all(axis=1), width, np.argmin(equal, axis=1))
    shared[same] = exact
    return order, shared


def repeated_windows(keys: np.ndarray, rows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, bytes to the left of its anchor) of each window that an earlier entry also has.

    Entries come in the order of their places. Windows around anchors of one gram are equal
    when their right parts and their left parts are: two suffix orders with common prefixes
    give both classes for every shift of the window.
    """
    side = window - GRAM
    by_key = np.argsort(keys, kind="stable")
    rows, bucket = rows[by_key], np.cumsum(np.diff(keys[by_key], prepend=keys[by_key[:1]]) != 0)
    left, right = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64)
    bytes_of = rows[:, 2:].astype(np.int16) + 1
    bytes_of[:, :side][np.arange(side) >= left[:, None]] = 0
    bytes_of[:, side:][np.arange(window) >= right[:, None]] = 0
    fresh = np.diff(bucket, prepend=-1) != 0
    ranks = []
    for part in (bytes_of[:, :side], bytes_of[:, side:]):
        order, shared = sorted_suffixes(part, bucket)
        ranks.append((order, np.where(fresh, -1, shared)))
    found, n = [], len(rows)
    for shift in range(side + 1):
        fits = np.flatnonzero((left >= shift) & (right >= window - shift))
        if len(fits) < 2:
            continue
        kind = np.zeros(n, np.int64)
        for (order, shared), need in zip(ranks, (shift, window - shift)):
            group = np.empty(n, np.int64)
            group[order] = np.cumsum(shared < need) - 1
            kind = kind * n + group
        later = fits[_later(kind[fits])]
        found.append(np.stack([by_key[later], np.full(len(later), shift)]))
    joined = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return joined[0], joined[1]


def _context_replies(window: int):
    """Starts of repeated windows."""

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = [_passed(table)]
        mine = _of_kind(table, WINDOW)
        hashes, sizes = _bodies(mine, "hashes", np.uint64)
        out.append(_replies(mine, sizes, {START: _later(hashes)}))
        mine = _of_kind(table, ROWS)
        keys, sizes = _bodies(mine, "hashes", np.uint64)
        if len(keys):
            body, _ = _bodies(mine, "extra", np.uint8)
            body = body.reshape(len(keys), -1)
            places = np.concatenate([unpacked_places(x) for x in mine.column("places").to_pylist()])
            chunk = np.repeat(np.arange(len(sizes)), sizes)
            found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for group in _blocks(keys):
                entry, shift = repeated_windows(keys[group], body[group], window)
                found[0].append(chunk[group[entry]])
                found[1].append(places[group[entry]] - shift)
            out.append(_starts(mine.column("chunk").to_numpy(), *map(np.concatenate, found)))
        return pa.concat_tables(out)

    return answer


def _starts(names: np.ndarray, row: np.ndarray, places: np.ndarray) -> pa.Table:
    """Window starts of each packet, sorted, as replies to its chunk."""
    order = np.lexsort((places, row))
    row, places = row[order], places[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (places[1:] != places[:-1])
    row, places = row[fresh], places[fresh]
    rows, edges = np.unique(row, return_index=True)
    return pa.table({
        "chunk": names[rows], "kind": np.full(len(rows), START, np.int32),
        "places": [packed_places(x) for x in np.split(places, edges[1:])] if len(rows) else [],
    }, schema=_REPLY)


def _blocks(keys: np.ndarray, most: int = LARGE_BUCKET):
    """Entries in their order, cut between keys into blocks of about ``most``."""
    order = np.argsort(keys, kind="stable")
    fresh = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]) != 0)
    edges, last = [], 0
    for at in np.append(fresh[1:], len(keys)):
        if at - last >= most or at == len(keys):
            edges.append((last, at))
            last = at
    for first, end in edges:
        yield np.sort(order[first:end])


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
])
_RESULT_SQL = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def _cut(window: int):
    """Remove the bytes that repeated windows cover."""

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _RESULT.empty_table()
        chunk = _Bytes(table, window, anchored=False)
        n = len(chunk.data)
        cover = np.zeros(n + 1, np.int64)
        starts = np.flatnonzero(_told(replies, START, n + 1))
        cover[starts] += 1
        cover[starts + window] -= 1
        full = np.flatnonzero(_told(replies, FULL, n + 1))
        left, right = chunk.reach(full)
        np.add.at(cover, full - left, 1)
        np.subtract.at(cover, full + right, 1)
        removed = np.cumsum(cover)[:-1] > 0
        found, kept = [], []
        for first, end in zip(chunk.offsets[:-1], chunk.offsets[1:]):
            mine, content = removed[first:end], chunk.data[first:end]
            if not mine.any():
                found.append([])
                kept.append(content.tobytes())
                continue
            edge = np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))
            found.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
            kept.append(content[~mine].tobytes())
        return pa.table({
            "doc_id": chunk.table.column("doc_id"), "n_bytes": np.diff(chunk.offsets), "spans": found, "kept": kept,
        }, schema=_RESULT)

    return cut


def remove_repeats(
    docs: DataFrame, window: int = 100, text: str = "text", chunk: int = CHUNK, part: int = PART, large: int = LARGE_BUCKET,
) -> DataFrame:
    """Remove every byte covered by a ``window`` of bytes that also starts earlier.

    Earlier is a smaller doc_id, or an earlier start in the same document; windows never
    cross documents and are judged on the input.

    1. Anchors are positions whose gram of ``GRAM`` bytes has the smallest hash of some
       window, about one in forty bytes. Anchors whose whole context (every window that can
       hold them) stands earlier are settled by a hash of it; grams that stand in one
       context only are no repeats.
    2. The rest, mostly the edges of repeats, are suffix-sorted by gram: mergesort with
       comparisons by prefix hashes and binary search, verified on bytes. Common prefixes
       of the sorted suffixes, read forwards and backwards from the anchor, tell for every
       window whether an earlier one equals it. Grams with more than ``large`` contexts go
       by the hashes of their windows instead, spread over all parts.

    The text is shuffled once and used three times; what a part receives is sent once per
    chunk, however often a string repeats there. Result: doc_id, n_bytes, spans of removed
    bytes (half-open, maximal), kept (remaining bytes). Null texts are empty; rows with a
    null doc_id come back whole; rows that repeat a doc_id follow in the order of texts.
    """
    if not GRAM < window < 256:
        raise ValueError(f"window must be over {GRAM} and under 256 bytes")
    size = text_bytes(docs, text)
    parts = parts_for(docs.sparkSession, size, part)
    by_chunk = chunked(docs, size, chunk, text=text).groupBy("chunk")
    sent = by_chunk.applyInArrow(_anchor_packets(window, parts), _PACKET_SQL)
    told = sent.groupBy("part").applyInArrow(_anchor_replies(large), _REPLY_SQL)
    unsettled = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_context_packets(window, parts), _PACKET_SQL)
    settled = unsettled.groupBy("part").applyInArrow(_context_replies(window), _REPLY_SQL)
    cut = by_chunk.cogroup(settled.groupBy("chunk")).applyInArrow(_cut(window), _RESULT_SQL)
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    unnamed = docs.where("doc_id IS NULL").select(
        F.lit(None).cast("long").alias("doc_id"), F.octet_length(content).cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"), content.alias("kept"),
    )
    return cut.unionByName(unnamed)
