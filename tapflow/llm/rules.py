"""Quality rules: statistics of every document, judged by an isolation forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapflow.llm.store import hash_sample, written
from tapflow.llm.text import chunks, laid_out, mix, byte_prefix, spans, window_hashes, words

TREES = 100
LEAF_SAMPLE = 16
# Documents that the forest's samples are drawn from, and the share of good documents it may reject.
SAMPLE = 20_000
CLEAN_LOSS = 0.015
BINS = 2000

# Characters that count as symbols.
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?\"'()[]{}:;/\\@^_~`+=")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_distinct"]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of all entries that stand twice or more, and of those that came before."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.zeros(len(ranked) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    several, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    several[order], later[order] = same[1:] | same[:-1], same[:-1]
    return several, later


def counted(data: np.ndarray, offsets: np.ndarray, window: int = 5) -> dict[str, np.ndarray]:
    """The rule counts of each text of a chunk."""
    rows = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    row = np.repeat(np.arange(rows), n_words)
    salt = mix(np.arange(rows, dtype=np.uint64) + np.uint64(1))
    sums = byte_prefix(data)
    hashed = spans(sums, starts, ends)

    head = np.append(data >> 6 != 2, True)  # bytes that begin a character
    begun = np.concatenate([[0], np.cumsum(head[:-1], dtype=np.int64)])
    word_chars = np.bincount(row, begun[ends] - begun[starts], minlength=rows).astype(np.int64)

    runs, at = window_hashes(hashed, first, window)
    several, _ = _repeats(runs ^ salt[row[at]])
    cover = np.zeros(len(hashed) + 1, np.int64)
    np.add.at(cover, at[several], 1)
    np.subtract.at(cover, at[several] + window, 1)
    repeated = np.cumsum(cover)[:-1] > 0
    _, seen = _repeats(hashed ^ salt[row])

    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    after = np.searchsorted(breaks, line_start)
    line_end = np.minimum(np.append(breaks, len(data))[after], offsets[line_row + 1])
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_row = line_start[with_word], line_end[with_word], line_row[with_word]
    _, again = _repeats(spans(sums, line_start, line_end) ^ salt[line_row])

    def by_row(where: np.ndarray, marked: np.ndarray) -> np.ndarray:
        return np.bincount(where[marked], minlength=rows).astype(np.int64)

    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": _per_row(_SYMBOLS[data], offsets),
        "n_dup_lines": by_row(line_row, again), "n_repeat_words": by_row(row, repeated),
        "n_lines": np.bincount(line_row, minlength=rows), "n_upper": _per_row(_UPPER[data], offsets),
        "n_letters": _per_row(_LETTER[data], offsets), "n_digits": _per_row(_DIGIT[data], offsets),
        "n_marks": _per_row(_MARK[data], offsets), "n_distinct": by_row(row, ~seen),
    }


def statistics(docs: DataFrame, text: str = "text", carry: bool = False) -> DataFrame:
    """doc_id and the rule counts of every whole text; ``carry`` adds all columns as _0, _1, ..."""
    columns = docs.columns if carry else []
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(columns))
    )
    kept = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(columns))
    names = ["doc_id", *(f"_{i}" for i in range(len(columns))), *COUNTS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = laid_out(batch.column(1))
            for first, end, part, places in chunks(data, offsets):
                found = counted(part, places)
                own = [batch.column(i).slice(first, end - first) for i in range(batch.num_columns) if i != 1]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(found[c], pa.int64()) for c in COUNTS)], names)

    return chosen.mapInArrow(count, "doc_id long, " + (kept + ", " if kept else "") + ", ".join(f"{c} long" for c in COUNTS))


def _rates() -> dict:
    """The rates that rules look at, by name."""
    n_words, letters, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_letters", "n_lines"))
    return {
        "word_length": F.col("word_chars") / n_words, "symbols": F.col("n_symbols") / n_words,
        "same_lines": F.col("n_dup_lines") / lines, "repeated": F.col("n_repeat_words") / n_words,
        "upper": F.col("n_upper") / letters, "digits": F.col("n_digits") / n_words, "marks": F.col("n_marks") / n_words,
        "distinct": F.col("n_distinct") / F.sqrt(n_words),
    }


RATES = ["word_length", "symbols", "same_lines", "repeated", "upper", "digits", "marks", "distinct"]


def rated(stats: DataFrame) -> DataFrame:
    """Add the rates, as rate_word_length and so on."""
    return stats.withColumns({f"rate_{name}": rate for name, rate in _rates().items()})


class IsolationForest:
    """Random splits of small samples; rows that few splits isolate score high."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, sample: int = LEAF_SAMPLE, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.depth = max(1, int(np.ceil(np.log2(min(sample, max(len(rows), 2))))))
        size = (1 << (self.depth + 1)) - 1
        self.feature = np.full((trees, size), -1, np.int32)
        self.cut = np.zeros((trees, size))
        self.length = np.zeros((trees, size))
        self.usual = self._expected(min(sample, len(rows)))
        for tree in range(trees):
            chosen = rows[draw.choice(len(rows), min(sample, len(rows)), replace=False)] if len(rows) else rows
            self._grow(tree, 0, 0, chosen, draw)

    @staticmethod
    def _expected(n: int) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, tree: int, node: int, depth: int, rows: np.ndarray, draw) -> None:
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        varied = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) < 2 or not len(varied):
            self.length[tree, node] = depth + self._expected(len(rows))
            return
        feature = draw.choice(varied)
        cut = draw.uniform(low[feature], high[feature])
        self.feature[tree, node], self.cut[tree, node] = feature, cut
        left = rows[:, feature] < cut
        self._grow(tree, 2 * node + 1, depth + 1, rows[left], draw)
        self._grow(tree, 2 * node + 2, depth + 1, rows[~left], draw)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly between 0 and 1; one half is usual."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, length in zip(self.feature, self.cut, self.length):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                asked = feature[node]
                below = rows[every, np.maximum(asked, 0)] < cut[node]
                node = np.where(asked < 0, node, 2 * node + 2 - below)
            total += length[node]
        return 2.0 ** -(total / len(self.feature) / max(self.usual, 1e-9))


def scored(rates: DataFrame, forest: IsolationForest) -> DataFrame:
    """The rows with the anomaly of each document."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(f"rate_{c}").to_numpy(zero_copy_only=False) for c in RATES], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(values))], [*batch.schema.names, "anomaly"])

    return rates.mapInArrow(judge, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rates.schema.fields) + ", anomaly double")


def fitted_forest(rates: DataFrame, sample: int = SAMPLE) -> IsolationForest:
    """A forest grown from at most ``sample`` documents, chosen by a hash over all of them."""
    names = [f"rate_{c}" for c in RATES]
    chosen = hash_sample(rates, ["doc_id", "n_words", "word_chars", *names], sample).select(*names).toPandas()
    return IsolationForest(chosen.to_numpy(dtype=float).reshape(-1, len(names)))


def calibrated(judged: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS) -> float:
    """The anomaly from which documents are rejected, from all labelled rows of ``judged``.

    Of all thresholds that reject at most ``clean_loss`` of the good rows, the one that
    rejects most bad rows (the highest such). Without good or bad rows nothing is rejected.
    """
    known = judged.join(labels.select("doc_id", "quality").where("quality IN (0, 1)").distinct(), "doc_id")
    bin_of = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    found = np.zeros((2, BINS))
    for row in known.groupBy("quality", bin_of).count().collect():
        found[row["quality"], row["bin"]] = row["count"]
    if not found.sum(axis=1).all():
        return float("inf")
    rejected = found[:, ::-1].cumsum(axis=1)[:, ::-1] / found.sum(axis=1, keepdims=True)
    allowed = np.flatnonzero(rejected[1] <= clean_loss)
    if not len(allowed):
        return float("inf")
    best = rejected[0][allowed]
    return float(allowed[np.flatnonzero(best == best.max())[-1]]) / BINS


def quality_rules(
    docs: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS, sample: int = SAMPLE, text: str = "text", carry: bool = False,
) -> DataFrame:
    """Judge every document by base rules and by an isolation forest on its rule statistics.

    The counts cover whole texts. The forest sees the rates made from them: its trees are
    grown on samples of ``LEAF_SAMPLE`` out of ``sample`` documents, every document is scored
    by its path lengths, and the threshold comes from all labelled rows that pass the base
    rules; a label row that repeats counts once for each document of its id. Result: doc_id, the rule counts,
    anomaly, threshold, base_failed (under 10 words, or more than 20 % of words in repeated
    5-word windows), kept. With ``carry`` the result is the kept rows of ``docs`` with their
    own columns, whatever their names. Null or empty texts have no words and fail; null
    doc_ids are judged but never match a label; repeated rows are judged each.
    """
    stats = written(statistics(docs, text), "statistics")
    rates = rated(stats)
    forest = fitted_forest(rates, sample)
    judged = scored(rates, forest).withColumn("base_failed", _failed())
    threshold = calibrated(judged.where("NOT base_failed"), labels, clean_loss)
    kept = ~F.col("base_failed") & (F.col("anomaly") < F.lit(threshold))
    if carry:
        rows = scored(rated(statistics(docs, text, carry=True)), forest).withColumn("base_failed", _failed())
        return rows.where(kept).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))
    return judged.drop(*(f"rate_{c}" for c in RATES)).withColumn("threshold", F.lit(threshold)).withColumn("kept", kept)


def _failed():
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
