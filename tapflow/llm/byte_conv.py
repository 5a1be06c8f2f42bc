"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapflow.llm.store import hash_sample
from tapflow.llm.text import chunks, laid_out, mix

# Chunks of a document overlap; the last one is moved back so that all bytes are covered.
CHUNK = 128
STEP = 96
WIDTH = 8
STRIDE = 2
EMBED = 8
FILTERS = 24
# Bounds of the training sample: documents per class, chunks per document.
DOCS_PER_CLASS = 1500
CHUNKS_PER_DOC = 12
EPOCHS = 14
BATCH = 128


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks that cover ``size`` bytes (one chunk even if it is short)."""
    if size <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, size - CHUNK + STEP, STEP, dtype=np.int64)
    return np.minimum(starts, size - CHUNK)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of the texts of a batch (bytes + 1, 0 beyond the end) and the row of each."""
    starts, rows = [], []
    for row, (low, high) in enumerate(zip(offsets[:-1], offsets[1:])):
        own = chunk_starts(int(high - low)) + low
        starts.append(own)
        rows.append(np.full(len(own), row))
    starts, rows = np.concatenate(starts), np.concatenate(rows)
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < offsets[rows + 1][:, None]
    padded = np.concatenate([data, np.zeros(1, np.uint8)])
    return np.where(inside, padded[np.minimum(at, len(data))].astype(np.int16) + 1, 0), rows


class ByteNetwork:
    """Embedded bytes, learned filters, maximum over each chunk, mean of chunk scores, sigmoid."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.weights = {
            "embed": draw.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            "filters": draw.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": draw.normal(0, 0.1, FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }

    def _windows(self, codes: np.ndarray) -> np.ndarray:
        """Embedded windows, flat: (chunks, positions, WIDTH * EMBED)."""
        embedded = self.weights["embed"][codes]
        seen = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)[:, ::STRIDE]
        return np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(len(codes), -1, WIDTH * EMBED)

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        windows = self._windows(codes)
        active = windows.reshape(-1, WIDTH * EMBED) @ self.weights["filters"]
        active = active.reshape(len(codes), -1, FILTERS)
        best = active.argmax(axis=1)
        top = np.take_along_axis(active, best[:, None], axis=1)[:, 0] + self.weights["bias"]
        return windows, best, top

    def chunk_scores(self, codes: np.ndarray) -> np.ndarray:
        active = self._windows(codes).reshape(-1, WIDTH * EMBED) @ self.weights["filters"]
        top = active.reshape(len(codes), -1, FILTERS).max(axis=1) + self.weights["bias"]
        return np.maximum(top, 0) @ self.weights["out"] + self.weights["base"][0]

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One probability per text, from all its chunks."""
        codes, rows = cut(data, offsets)
        score = np.concatenate([self.chunk_scores(codes[at: at + 1024]) for at in range(0, len(codes), 1024)])
        count = np.bincount(rows, minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.bincount(rows, score, minlength=len(offsets) - 1) / count))

    def fit(self, codes: np.ndarray, rows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 6) -> None:
        """Adam on the cross entropy of documents given as chunks; ``rows`` is increasing."""
        draw = np.random.default_rng(seed)
        bounds = np.searchsorted(rows, np.arange(len(labels) + 1))
        weigh = len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        total = epochs * -(-len(labels) // BATCH)
        for _ in range(epochs):
            order = draw.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                docs = order[at: at + BATCH]
                mine = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
                owner = np.repeat(np.arange(len(docs)), bounds[docs + 1] - bounds[docs])
                slopes = self._slopes(codes[mine], owner, labels[docs], weigh[labels[docs]])
                step += 1
                rate = 0.01 * (1 - step / (total + 1))
                for k, slope in slopes.items():
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                    change = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-7)
                    self.weights[k] = (self.weights[k] - rate * change).astype(np.float32)

    def _slopes(self, codes, owner, labels, weights) -> dict[str, np.ndarray]:
        windows, best, top = self.pooled(codes)
        active = np.maximum(top, 0)
        count = np.bincount(owner, minlength=len(labels))
        score = np.bincount(owner, active @ self.weights["out"] + self.weights["base"][0], minlength=len(labels)) / count
        error = (1 / (1 + np.exp(-score)) - labels) * weights / len(labels)
        each = (error / count)[owner].astype(np.float32)
        on_top = each[:, None] * self.weights["out"] * (top > 0)
        place = np.arange(len(codes))
        filters, embed = np.zeros_like(self.weights["filters"]), np.zeros_like(self.weights["embed"])
        for f in range(FILTERS):
            seen = windows[place, best[:, f]]
            filters[:, f] = seen.T @ on_top[:, f]
            back = on_top[:, f, None] * self.weights["filters"][:, f]
            at = best[:, f, None] * STRIDE + np.arange(WIDTH)
            np.add.at(embed, codes[place[:, None], at].ravel(), back.reshape(-1, EMBED))
        return {
            "embed": embed, "filters": filters, "bias": on_top.sum(axis=0),
            "out": active.T @ each, "base": np.array([each.sum()], np.float32),
        }


def held_out() -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _sampled_chunks(docs: DataFrame, text: str) -> DataFrame:
    """Up to ``CHUNKS_PER_DOC`` chunks of each document, chosen by a hash of their place."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, bodies = [], [], []
            data, offsets = laid_out(batch.column(2))
            for row, (low, high) in enumerate(zip(offsets[:-1], offsets[1:])):
                starts = chunk_starts(int(high - low))
                if len(starts) > CHUNKS_PER_DOC:
                    starts = starts[np.argsort(mix(starts.astype(np.uint64) + np.uint64(high - low)))[:CHUNKS_PER_DOC]]
                for start in starts:
                    ids.append(batch.column(0)[row].as_py())
                    labels.append(batch.column(1)[row].as_py())
                    bodies.append(data[low + start: min(high, low + start + CHUNK)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(bodies, pa.binary())], ["doc_id", "quality", "body"])

    return docs.select("doc_id", "quality", text).mapInArrow(choose, "doc_id long, quality int, body binary")


def trained(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS, text: str = "text") -> ByteNetwork | None:
    """A network fitted on at most ``per_class`` labelled rows of each class that are not held out.

    Rows are chosen by a hash of their id; of each, at most ``CHUNKS_PER_DOC`` chunks reach
    the driver, so the sample has a fixed size. None without rows of both classes.
    """
    known = labels.where("quality IN (0, 1)").where(~held_out()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = None
    for value in (0, 1):
        part = hash_sample(known.where(F.col("quality") == value).distinct(), ["doc_id"], per_class, salt=9)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = _sampled_chunks(docs.join(F.broadcast(chosen), "doc_id"), text).toPandas()
    if found["quality"].nunique() < 2:
        return None
    found = found.sort_values(["doc_id", "quality", "body"], kind="stable")
    data = np.frombuffer(b"".join(found["body"]), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found["body"]])])
    codes, _ = cut(data, offsets)
    key = found["doc_id"].to_numpy() * 2 + found["quality"].to_numpy()
    _, first, rows = np.unique(key, return_index=True, return_inverse=True)
    network = ByteNetwork()
    network.fit(codes, rows, found["quality"].to_numpy()[first])
    return network


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS, text: str = "text") -> DataFrame:
    """Score every whole text: probability of a quality label 1.

    A network reads overlapping chunks that cover the whole text, takes the maximum of each
    learned filter over a chunk, and combines the chunk scores by their mean into one
    probability. It is fitted on a bounded sample (see ``trained``) of labelled rows that are
    not held out; only the bytes of the text enter a score. Without labels of both classes
    every score is 0.5. Null texts are scored as empty ones; null ids are not held out.

    Result, per row: doc_id, held_out, score, predicted.
    """
    network = trained(docs, labels, per_class, text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = laid_out(batch.column(1))
            for first, end, part, places in chunks(data, offsets, 1 << 18):
                score = np.full(end - first, 0.5) if network is None else network.probabilities(part, places)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(score.astype(float))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(judge, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
