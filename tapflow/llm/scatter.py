"""Finding equal hashes over all documents with small shuffles.

Documents are dealt into chunks of about a megabyte that keep the order of ids: chunk, then
place in the chunk, orders all places of the corpus. A chunk sends each hash once, packed
with its place (four to eight bytes of hash, mostly one or two of place), to the part that
owns the hash; the part answers with the places that matter. A passage found in a third of
all documents therefore costs one entry per chunk, not one per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

RANGES = 256


def chunked(docs: DataFrame, size: int, each: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk, doc_id, text) of rows with an id; chunks follow the order of ids.

    ``size`` is the total of text bytes, ``each`` the bytes wanted in a chunk. Ids are cut
    at ``RANGES`` quantiles (a list of fixed length) and evenly inside each range, so gaps
    between ids don't make uneven chunks.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    inside = max(1, -(-size // (each * RANGES)))
    ranges = min(RANGES, max(1, -(-size // each)))
    points = [i / ranges for i in range(ranges + 1)]
    cuts = narrow.agg(F.percentile_approx("doc_id", points, 10 * RANGES)).first()[0]
    cuts = sorted(set(cuts or [0]))
    low, high = cuts, cuts[1:] + [cuts[-1] + 1]
    found = narrow.withColumn("at", _search(low))
    # in doubles, which keep the order and don't overflow on far ids
    start, end = F.lit([float(x) for x in low])[F.col("at")], F.lit([float(x) for x in high])[F.col("at")]
    step = F.floor((F.col("doc_id").cast("double") - start) / F.greatest(end - start, F.lit(1.0)) * inside)
    step = F.greatest(F.lit(0), F.least(step, F.lit(inside - 1)))
    return found.select((F.col("at") * inside + step).cast("long").alias("chunk"), "doc_id", "text")


def _search(low: list[int]):
    """Index of the last value of ``low`` that is at most doc_id, as a balanced tree of comparisons."""

    def node(first: int, last: int):
        if first == last:
            return F.lit(first)
        middle = (first + last + 1) // 2
        return F.when(F.col("doc_id") >= low[middle], node(middle, last)).otherwise(node(first, middle - 1))

    return node(0, len(low) - 1)


def packed_places(places: np.ndarray) -> bytes:
    """Increasing places as gaps of one byte, 255 meaning that the gap goes on."""
    gaps = np.diff(places, prepend=0)
    more = gaps // 255
    out = np.full(len(gaps) + int(more.sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gaps % 255
    return out.tobytes()


def unpacked_places(body: bytes) -> np.ndarray:
    gaps = np.frombuffer(body, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[np.flatnonzero(gaps != 255)]


def by_part(owner: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups entries by owner and keeps their order inside; bounds of each group."""
    kind = np.uint16 if parts <= 1 << 16 else np.int64
    order = np.argsort(owner.astype(kind), kind="stable")
    return order, np.searchsorted(owner[order], np.arange(parts + 1))


def firsts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, place), whether each entry in that order heads its group, and the group of each."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    head = np.ones(len(ranked), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    return order, head, np.cumsum(head) - 1


def in_order(table: pa.Table, *names: str) -> pa.Table:
    return table.sort_by([(name, "ascending") for name in names]) if table.num_rows else table
