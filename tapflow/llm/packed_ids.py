"""Token ids in files of fixed-width bit packing, written in the order of documents and read at any place.

A file holds the ids of whole documents, one after another, in blocks of ``BLOCK_IDS``:
every id takes the bits that the largest id of the vocabulary needs, least significant bit
first, and a block begins on a whole byte. Behind the blocks stand the documents (id, whether
it has one, number of ids), the byte offset of each block and a trailer of fixed size, so a
reader finds any id with two small reads and unpacks only the blocks it asks for. A manifest
names the committed files in order with the number of ids before each.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tapflow.llm.store import parts_for, text_bytes
from tapflow.llm.text import chunks, laid_out
from tapflow.llm.warc import place

BLOCK_IDS = 1 << 16
FILE_BYTES = 1 << 27
PART_BYTES = 32 << 20
# Ids that a reader hands on at once; a longer document is a batch of its own.
BATCH_IDS = 1 << 20
# Words, and bytes of words, whose ids a worker remembers.
WORDS_HELD = 800_000
WORD_BYTES_HELD = 32 << 20
SLICE_BYTES = 1 << 20
# New words that are encoded as one text.
JOINED = 256
MANIFEST = "_manifest.json"

# The mark at the start and the end of a file, and the trailer before the last mark:
# bits, ids a block, documents, ids, place of the documents, place of the block offsets.
MARK = b"IDPACK01"
TRAILER = "<IIQQQQ"


# Words to ids


class _Numbered(dict):
    """Words by number; an unknown word gets the next one and is put down as new."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


class WordIds:
    """Ids of texts by a tokenizer that drops white space, each distinct word encoded once.

    Such a tokenizer cuts at white space and never looks across it, so the ids of a text are
    those of its words in order. What is remembered is bounded and then begun anew.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        names = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_word[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.held = _Numbered(), 0
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self) -> None:
        """Encode the new words, many in one text."""
        new, self.known.new = [w.decode() for w in self.known.new], []
        plain = np.fromiter(map(str.isalpha, new), bool, len(new))
        counts, first, found = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), []
        size = len(self.flat)
        for group, encode in ((np.flatnonzero(plain), self._by_word_ends), (np.flatnonzero(~plain), self._by_offsets)):
            own, ids = encode([new[i] for i in group.tolist()])
            counts[group], first[group] = own, size + np.cumsum(own) - own
            found.append(ids)
            size += len(ids)
        self.held += sum(map(len, new))
        self.first, self.count = np.concatenate([self.first, first]), np.concatenate([self.count, counts])
        self.flat = np.concatenate([self.flat, *found])

    def _by_word_ends(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids: words of letters alone mostly end at an id that
        marks the end of a word. Where these are not as many as words, offsets decide."""
        texts = [" ".join(words[at: at + JOINED]) for at in range(0, len(words), JOINED)]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        ends = np.flatnonzero(self.ends_word[ids])
        expected = np.minimum(np.arange(JOINED, len(texts) * JOINED + 1, JOINED), len(words))
        if not np.array_equal(np.searchsorted(ends, np.cumsum(sizes)), expected) or not np.isin(np.cumsum(sizes) - 1, ends).all():
            return self._by_offsets(words)
        return np.diff(ends, prepend=-1), ids

    def _by_offsets(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids, by where each id begins in the joined text."""
        texts = [" ".join(words[at: at + JOINED]) for at in range(0, len(words), JOINED)]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.int32, int(sizes.sum()))
        begins = np.fromiter(chain.from_iterable(map(itemgetter(0), x.offsets) for x in found), np.int64, len(ids))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(lengths) - lengths  # as if all texts were one
        own = np.searchsorted(starts, begins + np.repeat(starts[::JOINED], sizes), "right") - 1
        return np.bincount(own, minlength=len(words)), ids

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words laid end to end, and the number of ids of each."""
        if len(self.known) > WORDS_HELD or self.held > WORD_BYTES_HELD:
            self._forget()
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if self.known.new:
            self._learn()
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        at = np.repeat(self.first[numbers] - (ends - counts), counts) + np.arange(int(counts.sum()))
        return self.flat[at], counts

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk of texts laid end to end, and the number of ids of each text."""
        if len(offsets) == 2 and len(data) > SLICE_BYTES:
            found = [self.encode(x.split())[0] for x in slices(data.tobytes())]
            return np.concatenate(found), np.array([sum(map(len, found))])
        whole = data.tobytes()
        split = [whole[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        ids, counts = self.encode([w for own in split for w in own])
        ends = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        before = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]
        return ids, np.diff(before)


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """Cut a long text at white space into slices of about ``size`` bytes; a longer word stays whole."""
    first = 0
    while first < len(text):
        found = _SPACE.search(text, first + size)
        end = found.start() if found else len(text)
        yield text[first:end]
        first = end


@lru_cache(maxsize=2)
def _word_ids(path: str, special_as_text: bool) -> WordIds:
    return WordIds(path, special_as_text)


def vocabulary_bits(path: str, end_id: int) -> int:
    """Bits that the largest id takes."""
    from tokenizers import Tokenizer

    return max(1, max(Tokenizer.from_file(path).get_vocab_size() - 1, end_id).bit_length())


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", special_as_text: bool = True) -> DataFrame:
    """doc_id and ids (array<int>) of every whole text, ``end_id`` last; null counts as empty.

    ``tokenizer`` is a file of the tokenizers library that drops white space; no special
    tokens are added, and their strings in a text are ordinary text unless asked otherwise.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer, special_as_text)
        for batch in batches:
            data, offsets = laid_out(batch.column(1))
            for first, end, part, places in chunks(data, offsets):
                ids, counts = words.rows(part, places)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.int32)
                bounds = pa.array(np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.ListArray.from_arrays(bounds, pa.array(ids))], ["doc_id", "ids"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(encode, "doc_id long, ids array<int>")


# Packing


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids side by side in ``bits`` bits each, least significant first; whole bytes, the rest 0."""
    padded = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    padded[: len(ids)] = ids
    lanes = padded.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        for byte in range(lane * bits // 8, -(-(lane + 1) * bits // 8)):
            shift = 8 * byte - lane * bits
            moved = lanes[:, lane] >> np.uint64(shift) if shift >= 0 else lanes[:, lane] << np.uint64(-shift)
            out[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(content: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids of packed bytes, eight lanes at a time."""
    rows = -(-n // 8)
    data = np.zeros(rows * bits, np.uint8)
    data[: len(content)] = np.frombuffer(content, np.uint8)[: rows * bits]
    data = data.reshape(rows, bits)
    out = np.zeros((rows, 8), np.uint64)
    for lane in range(8):
        for byte in range(lane * bits // 8, -(-(lane + 1) * bits // 8)):
            shift = 8 * byte - lane * bits
            value = data[:, byte].astype(np.uint64)
            out[:, lane] |= value << np.uint64(shift) if shift >= 0 else value >> np.uint64(-shift)
    return (out & np.uint64((1 << bits) - 1)).reshape(-1)[:n].astype(np.uint32)


class _File:
    """One file being written: blocks as they fill, then documents, offsets and trailer."""

    def __init__(self, out, bits: int, block: int):
        self.out, self.bits, self.block = out, bits, block
        self.pending: list[np.ndarray] = []
        self.waiting = self.ids = self.size = 0
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.offsets: list[int] = []
        self._put(MARK)

    def _put(self, content: bytes) -> None:
        self.out.write(content)
        self.size += len(content)

    def add(self, doc_ids: np.ndarray, valid: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.docs.append((doc_ids, valid, counts))
        self.pending.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= self.block:
            rest = np.concatenate(self.pending)
            whole = len(rest) // self.block * self.block
            for at in range(0, whole, self.block):
                self._block(rest[at: at + self.block])
            self.pending, self.waiting = [rest[whole:]], len(rest) - whole

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.size)
        self._put(pack(ids, self.bits))

    def close(self) -> tuple[int, int]:
        if self.waiting:
            self._block(np.concatenate(self.pending))
        self.offsets.append(self.size)
        docs_at, n_docs = self.size, sum(len(x[0]) for x in self.docs)
        for column, kind in enumerate(("<i8", "u1", "<i8")):
            for each in self.docs:
                self._put(each[column].astype(kind).tobytes())
        offsets_at = self.size
        self._put(np.array(self.offsets, "<i8").tobytes())
        self._put(struct.pack(TRAILER, self.bits, self.block, n_docs, self.ids, docs_at, offsets_at) + MARK)
        self.out.close()
        return n_docs, self.ids


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[tuple[str, int, int]]


class PackedWriter(DataSourceArrowWriter):
    """Each task writes its own files; the driver names the committed ones, in order of partitions."""

    def __init__(self, options: dict):
        self.path, self.bits = options["path"], int(options["bits"])
        self.block, self.file_bytes = int(options.get("block_ids", BLOCK_IDS)), int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = place(self.path)
        system.create_dir(folder, recursive=True)
        task = TaskContext.get()
        done: list[tuple[str, int, int]] = []
        file, name = None, ""
        for batch in iterator:
            doc_ids, lists = batch.column(0), batch.column(1)
            numbers = doc_ids.fill_null(0).to_numpy()
            valid = np.asarray(doc_ids.is_valid())
            bounds, ids = np.asarray(lists.offsets), np.asarray(lists.values)
            ends = np.searchsorted(bounds, np.arange(bounds[0], bounds[-1], BATCH_IDS) + BATCH_IDS, "left").clip(max=len(valid))
            first = 0
            for end in [*np.unique(ends).tolist(), len(valid)]:
                if end == first:
                    continue
                if file is None or file.size >= self.file_bytes:
                    if file is not None:
                        done.append((name, *file.close()))
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.ids"
                    file = _File(system.open_output_stream(f"{folder}/{name}", compression=None), self.bits, self.block)
                file.add(numbers[first:end], valid[first:end], np.diff(bounds[first: end + 1]), ids[bounds[first]: bounds[end]])
                first = end
        if file is not None:
            done.append((name, *file.close()))
        return Written(task.partitionId(), done)

    def commit(self, messages: list) -> None:
        system, folder = place(self.path)
        system.create_dir(folder, recursive=True)
        files, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for name, docs, ids in message.files:
                files.append({"name": name, "docs": docs, "ids": ids, "start": start})
                start += ids
        with system.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"bits": self.bits, "ids": start, "files": files}).encode())

    def abort(self, messages: list) -> None:
        system, folder = place(self.path)
        for message in messages:
            for name, _, _ in message.files if message else []:
                system.delete_file(f"{folder}/{name}")


# Reading


class PackedFile:
    """One file opened at its trailer; blocks are read when their ids are asked for."""

    def __init__(self, file):
        self.file = file
        size = struct.calcsize(TRAILER)
        tail = file.read_at(size + len(MARK), max(0, file.size() - size - len(MARK)))
        if tail[size:] != MARK:
            raise ValueError("not a file of packed ids, or cut short")
        self.bits, self.block, self.n_docs, self.n_ids, self.docs_at, self.offsets_at = struct.unpack(TRAILER, tail[:size])

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, whether it has one, and number of ids of each document."""
        n = self.n_docs
        content = self.file.read_at(17 * n, self.docs_at)
        return np.frombuffer(content, "<i8", n), np.frombuffer(content, "u1", n, 8 * n).astype(bool), np.frombuffer(content, "<i8", n, 9 * n)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        end = min(end, self.n_ids)
        if start >= end:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        places = np.frombuffer(self.file.read_at(8 * (last - first + 2), self.offsets_at + 8 * first), "<i8")
        content = self.file.read_at(int(places[-1] - places[0]), int(places[0]))
        found = []
        for at in range(first, last + 1):
            n = min(self.block, self.n_ids - at * self.block)
            found.append(unpack(content[places[at - first] - places[0]: places[at - first + 1] - places[0]], self.bits, n))
        return np.concatenate(found)[start - first * self.block: end - first * self.block]


def manifest(path: str) -> dict:
    system, folder = place(path)
    with system.open_input_stream(f"{folder}/{MANIFEST}") as source:
        return json.loads(source.read())


def ids_between(path: str, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of the whole corpus, without reading the rest of its files."""
    system, folder = place(path)
    files = [x for x in manifest(path)["files"] if x["ids"]]
    at = max(0, bisect.bisect_right([x["start"] for x in files], start) - 1)
    found = []
    while at < len(files) and files[at]["start"] < end:
        with system.open_input_file(f"{folder}/{files[at]['name']}") as file:
            found.append(PackedFile(file).ids(max(0, start - files[at]["start"]), end - files[at]["start"]))
        at += 1
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


@dataclass
class FilePart(InputPartition):
    name: str
    start: int


class PackedReader(DataSourceReader):
    """One partition per file; documents come in the order of the file with their global start."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[FilePart]:
        return [FilePart(x["name"], x["start"]) for x in manifest(self.path)["files"]]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, folder = place(self.path)
        with system.open_input_file(f"{folder}/{partition.name}") as source:
            file = PackedFile(source)
            doc_ids, valid, counts = file.documents()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            first = 0
            while first < len(counts):
                end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + BATCH_IDS, "right")) - 1)
                ids = file.ids(int(bounds[first]), int(bounds[end])).astype("<u4")
                places = pa.array(((bounds[first: end + 1] - bounds[first]) * 4).astype(np.int64))
                content = pa.LargeBinaryArray.from_buffers(pa.large_binary(), end - first, [None, places.buffers()[1], pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids[first:end], mask=~valid[first:end]), pa.array(partition.start + bounds[first:end]),
                    pa.array(counts[first:end]), content.cast(pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])
                first = end


class PackedSource(DataSource):
    """format("packed_ids") with options path, bits, block_ids, file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> PackedReader:
        return PackedReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> PackedWriter:
        return PackedWriter(dict(self.options))


def write_packed(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", special_as_text: bool = True,
    part_bytes: int = PART_BYTES, **options,
) -> None:
    """Encode every whole text and write its ids to ``path`` in ascending order of doc_id.

    ``path`` must be new, on storage that the driver and all executors share. Texts are
    range-sorted by doc_id before they are encoded; rows repeating an id follow each other
    in order of a hash of their text, are written each, and spread over tasks if they are
    many. Null ids come first; null and empty texts hold the end id alone; further columns
    are not read. An empty table gives a manifest without files. A text is encoded in slices
    cut at white space, so beyond its ids (four bytes each) its length costs no memory.
    """
    spark = docs.sparkSession
    spark.dataSource.register(PackedSource)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).withColumns(
        {"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    parts = parts_for(spark, text_bytes(docs, text), part_bytes)
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    bits = vocabulary_bits(tokenizer, end_id)
    ids = token_ids(ordered, tokenizer, end_id, special_as_text=special_as_text)
    ids.write.format("packed_ids").mode("append").options(path=path, bits=bits, **options).save()


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (unsigned 32-bit little-endian)."""
    spark.dataSource.register(PackedSource)
    return spark.read.format("packed_ids").options(path=path).load()
