"""Whole Arrow batches of texts as numpy arrays: words, their hashes, hashes of word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# A chunk of texts that is handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight
LONG_WORD = 1024  # bytes, beyond which a word is hashed by itself
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

# Words end at these bytes: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words(NamedTuple):
    start: np.ndarray  # first byte
    end: np.ndarray  # byte after the last
    doc: np.ndarray  # row within the chunk, ascending
    hash: np.ndarray  # uint64
    first: np.ndarray  # first word of each row, and the number of words at the end


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        made = []
        for factor in (_BASE, _INVERSE):
            p = np.full(size, factor, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if size > 4 * CHUNK_BYTES:  # one very long text; don't keep its tables
            return made[0][:n], made[1][:n]
        _powers = (made[0], made[1])
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] from prefix_sums(values); the same wherever the values stand.

    Values are hashes and spans have less than a thousand of them: a sum of powers modulo 2**64 is good for such."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64))


def word_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], eight bytes after the other, each step a mix of all before.

    Words of up to eight bytes and equal length never share one, and there is no rule by which longer ones do: a sum of
    powers would give equal hashes to certain regular words.
    """
    size = end - start
    value = mix(size.astype(np.uint64) + _STEP)
    eight = np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)), 0, (1,))
    row = np.flatnonzero(size <= LONG_WORD)
    at, left = start[row], size[row]
    while len(row):
        value[row] = mix((value[row] ^ (eight[at] & HEAD[np.minimum(left, 8)])) * _STEP + np.uint64(1))
        more = left > 8
        row, at, left = row[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        value[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return value


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most `limit` bytes of text (or one row), their bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = texts(batch.column(batch.schema.get_field_index(column)))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield batch.slice(row, stop - row), data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
            row = stop


def spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, the row of each, and the first word of each row (and the number of words at the end)."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    gap = space[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = gap[:-1]
    after[:-1] = gap[1:]
    start = np.flatnonzero(~gap & (before | edge[:n]))
    end = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1, np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    start, end, doc, first = spans(data, offsets, space)
    return Words(start, end, doc, word_hash(data, start, end), first)


def windows(w: Words, size: int) -> np.ndarray:
    """Starts of all windows of `size` words within one row."""
    if len(w.doc) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(w.doc[: len(w.doc) - size + 1] == w.doc[size - 1:])
