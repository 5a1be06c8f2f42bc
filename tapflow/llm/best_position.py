"""Ranked lexical search: impact lists read by the Best Position Algorithm.

Documents are dealt into shards as they are scanned; a shard keeps, for every term that the
queries ask for, its postings. Once the counts of the whole table are known, a shard turns
them into lists in falling order of impact and answers each query on its own: the lists are
read side by side, every document met is scored by direct accesses to all lists, and each
list remembers up to which position it has been seen without a gap. The impacts at these
best positions add up to what an unmet document can reach at most; reading stops once that
is strictly below the kth score, so ties are never cut off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapflow.llm.packed_ids import slices
from tapflow.llm.store import written

SHARD_DOCS = 8192
SHARD_POSTINGS = 1 << 20
# Terms of queries that one pass holds; more queries are answered in several passes.
PASS_TERMS = 500_000
FIRST_DEPTH = 32
CELLS = 1 << 18
SALTS = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A byte table for texts: what is no term becomes a space, A-Z become lower case.
_AS_TERMS = bytes(c + 32 if 65 <= c < 91 else c if c > 127 or 48 <= c < 58 or 97 <= c < 123 else 32 for c in range(256))

INDEX = "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, dfs array<int>, places binary, counts binary"


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id and its distinct terms; rows repeating an item_id are one item."""
    found = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1))
    each = items.select(F.col(item_id).alias("item_id"), F.explode(F.array_distinct(found)).alias("term"))
    return each.groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def term_numbers(text: bytes, number_of: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """Number of terms of a whole text, and the numbers of those that queries ask for."""
    total, found = 0, []
    for part in slices(text.translate(_AS_TERMS)):
        own = part.split()
        total += len(own)
        found.append(np.array([x for x in map(number_of.get, own) if x is not None], np.int64))
    return total, np.concatenate(found) if found else np.zeros(0, np.int64)


def indexed(docs: DataFrame, vocabulary: list[str], text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per shard: counts of its documents and terms, its documents, and the postings of
    each term of ``vocabulary``, as places of documents and numbers of occurrences."""

    def shard(doc_ids: list, lengths: list[int], hits: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, hits), np.int64, len(hits))
        holds = np.flatnonzero(sizes)
        place = np.repeat(np.arange(len(holds)), sizes[holds])
        keys, counts = np.unique(np.concatenate([*hits, np.zeros(0, np.int64)]) * max(len(holds), 1) + place, return_counts=True)
        terms, heads = np.unique(keys // max(len(holds), 1), return_index=True)
        dfs = np.diff(np.append(heads, len(keys)))
        return pa.RecordBatch.from_arrays([
            pa.array([sum(n > 0 for n in lengths)], pa.int64()), pa.array([sum(lengths)], pa.int64()),
            pa.array([[doc_ids[i] for i in holds]], pa.list_(pa.int64())), pa.array([[lengths[i] for i in holds]], pa.list_(pa.int64())),
            pa.array([terms.astype(np.int32)], pa.list_(pa.int32())), pa.array([dfs.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([(keys % max(len(holds), 1)).astype("<i4").tobytes()], pa.binary()), pa.array([counts.astype("<i4").tobytes()], pa.binary()),
        ], ["n_docs", "n_terms", "doc_ids", "lengths", "terms", "dfs", "places", "counts"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = {term.encode(): number for number, term in enumerate(vocabulary)}
        doc_ids, lengths, hits, size = [], [], [], 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(batch.num_rows):
                n, found = term_numbers((texts[at].as_py() or "").encode(), number_of)
                doc_ids.append(ids[at].as_py())
                lengths.append(n)
                hits.append(found)
                size += len(found)
                if len(doc_ids) >= shard_docs or size >= SHARD_POSTINGS:
                    yield shard(doc_ids, lengths, hits)
                    doc_ids, lengths, hits, size = [], [], [], 0
        if doc_ids:
            yield shard(doc_ids, lengths, hits)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(build, INDEX)


class Shard:
    """Lists of one shard in falling order of impact, with direct access by document."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, dfs: np.ndarray, places: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        number = np.repeat(np.arange(len(terms)), dfs)
        spread = 50 + (50 * lengths * n_docs) // n_terms
        counts = counts.astype(np.int64)
        impact = weights[terms[number]] * ((1_000_000_000 * counts) // (1000 * counts + 20 * spread[places]))
        order = np.lexsort((-impact, number))
        order = order[impact[order] > 0]
        self.list, self.doc, self.impact = number[order], places[order].astype(np.int64), impact[order]
        self.bounds = np.searchsorted(self.list, np.arange(len(terms) + 1))
        self.of_term = {int(term): i for i, term in enumerate(terms)}
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.doc_bounds = np.searchsorted(self.doc[self.by_doc], np.arange(len(lengths) + 1))
        # per query, and cleared after it
        self.seen = np.zeros(len(order), bool)
        self.met = np.zeros(len(lengths), bool)
        self.asked = np.zeros(len(terms), bool)

    def best(self, terms: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of documents, all that can be among the ``k`` highest, and the depth read.

        ``floor`` is a score that ``k`` documents elsewhere reach already: documents below it are
        not looked for.
        """
        lists = np.array([i for i in map(self.of_term.get, terms.tolist()) if i is not None], np.int64)
        starts, ends = self.bounds[lists], self.bounds[lists + 1]
        lists, starts, ends = lists[ends > starts], starts[ends > starts], ends[ends > starts]
        self.asked[lists] = True
        best_position = starts.copy()
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        all_met, low, block = [], 0, FIRST_DEPTH
        while len(lists):
            # sorted access: the next block of every list
            grid = starts[:, None] + np.arange(low, low + block)
            met = np.unique(self.doc[grid[grid < ends[:, None]]])
            new = met[~self.met[met]]
            self.met[new] = True
            all_met.append(new)
            if len(new):
                # direct access: every list's posting of the new documents
                sizes = self.doc_bounds[new + 1] - self.doc_bounds[new]
                after = np.cumsum(sizes)
                postings = self.by_doc[np.repeat(self.doc_bounds[new] - (after - sizes), sizes) + np.arange(after[-1])]
                owner = np.repeat(np.arange(len(new)), sizes)
                own = self.asked[self.list[postings]]
                postings, owner = postings[own], owner[own]
                self.seen[postings] = True
                score = np.add.reduceat(self.impact[postings], np.flatnonzero(np.diff(owner, prepend=-1)))
                docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            low += block
            # best positions: as far as a list has been seen without a gap
            for i in np.flatnonzero(best_position < ends).tolist():
                rest = self.seen[best_position[i]: ends[i]]
                gap = int(rest.argmin())
                best_position[i] = ends[i] if rest[gap] else best_position[i] + gap
            still = best_position < ends
            if not still.any():
                break
            limit = int(self.impact[best_position[still] - 1].sum()) if (best_position[still] > starts[still]).all() else None
            least = max(floor, int(np.partition(scores, -k)[-k]) if len(scores) >= k else 0)
            if limit is not None and least and limit < least:
                break
            block = max(1, min(block * 2, CELLS // len(lists)))
        for start, end in zip(starts, ends):
            self.seen[start:end] = False
        for new in all_met:
            self.met[new] = False
        self.asked[lists] = False
        if len(scores) > k:
            least = max(floor, int(np.partition(scores, -k)[-k]))
            docs, scores = docs[scores >= least], scores[scores >= least]
        return docs, scores, low


def top(scores: np.ndarray, valid: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties by ascending id, missing ids first."""
    order = np.lexsort((ids, valid, -scores))[:k]
    return scores[order], valid[order], ids[order]


def _searched(index: DataFrame, queries: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item (its number), doc_id, score: the ``k`` best of each query among the shards of a task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [np.array(x, np.int64) for x in queries]
        nothing = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best = [nothing] * len(asked)
        for batch in batches:
            for row in range(batch.num_rows):
                _, _, doc_ids, lengths, terms, dfs, places, counts = (batch.column(i)[row] for i in range(8))
                ids = doc_ids.values
                valid, ids = np.asarray(ids.is_valid()), ids.fill_null(0).to_numpy()
                shard = Shard(
                    lengths.values.to_numpy(), terms.values.to_numpy(), dfs.values.to_numpy(),
                    np.frombuffer(places.as_py(), "<i4"), np.frombuffer(counts.as_py(), "<i4"), weights, n_docs, n_terms,
                )
                for number, own in enumerate(asked):
                    scores, known, names = best[number]
                    floor = int(scores[-1]) if len(scores) == k else 0
                    docs, found, _ = shard.best(own, k, floor)
                    if len(docs):
                        best[number] = top(
                            np.concatenate([scores, found]), np.concatenate([known, valid[docs]]), np.concatenate([names, ids[docs]]), k
                        )
        for number, (scores, known, names) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(scores), number, np.int32)), pa.array(names, mask=~known), pa.array(scores)], ["item", "doc_id", "score"]
                )

    return index.mapInArrow(search, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", item_id: str = "item_id", pass_terms: int = PASS_TERMS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The ``k`` highest-scoring documents of each item with a score above 0: item_id, rank, doc_id, score.

    Terms are maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
    Scores, in whole numbers, add w * (1e9 tf div (1000 tf + 20 m)) over the item's distinct
    terms, with w = floor(1000 ln((2N+2) / (2df+1))) and m = 50 + (50 n N div L). Equal scores
    rank by ascending doc_id, a missing one first. Null and empty texts have no terms and are
    not counted; items without terms have no rows. Every row of ``docs`` is a document, rows
    repeating a doc_id too; rows repeating an item_id are one item. Further columns are not
    read. Items are answered in passes of about ``pass_terms`` terms (an item's terms stay
    together), so what tasks are sent is bounded; each pass scans the documents once.
    """
    spark = docs.sparkSession
    terms = written(query_terms(items, item_id, text), "items")
    total = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    passes = -(-total // pass_terms)
    found = []
    for number in range(passes):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).collect()
        vocabulary = sorted({term for row in own for term in row["terms"]})
        if not vocabulary:
            continue
        number_of = {term: i for i, term in enumerate(vocabulary)}
        index = written(indexed(docs, vocabulary, text, shard_docs), "index")
        n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        if not n_terms:
            continue
        weights = np.zeros(len(vocabulary), np.int64)
        counted = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df"))
        for row in counted.collect():
            weights[row["terms"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
        queries = [[number_of[term] for term in row["terms"]] for row in own]
        best = _searched(index, queries, weights, n_docs, n_terms, k)
        names = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(own)], f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}")
        found.append(_first_k(best, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {terms.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _first_k(best: DataFrame, k: int) -> DataFrame:
    """Rank within each item, in two rounds so that no task sees the best of all others at once."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    salted = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    part = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
