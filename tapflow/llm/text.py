"""Whole-column text arithmetic on Arrow batches: words, rolling hashes, chunks of rows.

A word is a maximal run of bytes other than space and the controls 9 to 13. All functions
take the bytes of many texts laid end to end with their offsets, so the cost of a call is
shared by the rows of a chunk. Chunks hold about 256 kilobytes of text (one text if it
is longer), which bounds the memory of a task whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt * 0x632BE59BD9B4E019 & _MASK))


# Hashes are polynomials modulo the prime 2**61 - 1. (Modulo a power of two, strings built by
# the Thue-Morse rule collide whatever the base.)
PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_POINT = 0x0B5A1C3D9E4F7261
_BLOCK = 1 << 18
_STEP = 1 << 14  # values whose arrays stay in a processor's cache


def _reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2**64 modulo the prime."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Product modulo the prime of values below it, by halves of 31 bits."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a_high, a_low, b_high, b_low = a >> half, a & low, b >> half, b & low
    middle = a_low * b_high
    middle += a_high * b_low
    out = a_high * b_high
    out <<= np.uint64(1)
    out += middle >> np.uint64(30)
    middle &= np.uint64((1 << 30) - 1)
    middle <<= half
    out += middle
    out += a_low * b_low
    return _reduced(out)


def _table(base: int) -> np.ndarray:
    """The first ``_BLOCK`` powers of ``base``."""
    out = np.ones(1, np.uint64)
    while len(out) < _BLOCK:
        out = np.concatenate([out, times(out, np.uint64(pow(base, len(out), PRIME)))])
    return out


_POWERS, _INVERSES = _table(_POINT), _table(pow(_POINT, -1, PRIME))
_POWERS_HIGH, _POWERS_LOW = _POWERS >> np.uint64(32), _POWERS & np.uint64(0xFFFFFFFF)


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """high * 2**32 + low: a product with 2**32 is a turn by 32 of the 61 bits."""
    return _reduced(((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (high >> np.uint64(29)) + low)


def _running(x: np.ndarray) -> np.ndarray:
    """Running sums, modulo the prime, of at most ``_STEP`` values."""
    low = np.cumsum(x & np.uint64(0xFFFFFFFF))
    high = np.cumsum(x >> np.uint64(32))
    return _joined(high, low)


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: entry i covers the first i values.

    Powers are kept for one block; further blocks multiply by the power of their start, so a
    long text takes no longer table.
    """
    out = np.zeros(len(values) + 1, np.uint64)
    for at in range(0, len(values), _STEP):
        block = _reduced(values[at: at + _STEP])
        block = times(block, _POWERS[at % _BLOCK: at % _BLOCK + len(block)])
        if at >= _BLOCK:
            block = times(block, np.uint64(pow(_POINT, at // _BLOCK * _BLOCK, PRIME)))
        out[at + 1: at + 1 + len(block)] = _reduced(_running(block) + out[at])
    return out


def spans(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each half-open span, the same wherever its content stands."""
    raw = _reduced(hashes[ends] + (_P - hashes[starts]))
    raw = times(raw, _INVERSES[starts % _BLOCK])
    if len(hashes) > _BLOCK:
        jumps = np.array([pow(_POINT, -at, PRIME) for at in range(0, len(hashes), _BLOCK)], np.uint64)
        raw = times(raw, jumps[starts // _BLOCK])
    return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix hashes of bytes, whose sums of products fit 64 bits by halves."""
    out = np.zeros(len(data) + 1, np.uint64)
    for at in range(0, len(data), _STEP):
        value = data[at: at + _STEP].astype(np.uint64) + np.uint64(1)
        own = slice(at % _BLOCK, at % _BLOCK + len(value))
        block = _joined(np.cumsum(value * _POWERS_HIGH[own]), np.cumsum(value * _POWERS_LOW[own]))
        if at >= _BLOCK:
            block = times(block, np.uint64(pow(_POINT, at // _BLOCK * _BLOCK, PRIME)))
        out[at + 1: at + 1 + len(block)] = _reduced(block + out[at])
    return out


def laid_out(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, content = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if large else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut rows into chunks of about ``size`` bytes: first row, end row, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first]: offsets[end]], offsets[first: end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the index of its first word (plus the total)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    start[heads] = inside[heads]
    end = np.zeros(n + 1, bool)
    end[1:] = inside
    end[1:n] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0]
    end[tails] = inside[tails - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans(byte_prefix(data), starts, ends)


def window_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside one row, and the word each run starts at."""
    total = len(hashes)
    if total < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    starts = np.flatnonzero(left >= k)
    return spans(prefix(hashes), starts, starts + k), starts
