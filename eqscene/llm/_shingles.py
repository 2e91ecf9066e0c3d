"""Vectorised hashes of words and word shingles, for use inside tasks.

A batch of texts is one byte buffer; words are runs of bytes above the space
character. A shingle is ``SHINGLE`` consecutive words; a text with fewer words, but
not none, is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Hashing takes some ten times a chunk, in each worker.
CHUNK_BYTES = 250_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES each, at least one text."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > CHUNK_BYTES:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def byte_chunks(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """The same ranges of a column of texts, each with its UTF-8 bytes: only one range is held as Python objects."""
    raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    end = np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(raw):
        before = end[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(end, before + CHUNK_BYTES, "right")))
        yield i, j, raw.slice(i, j - i).to_pylist()
        i = j


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and the number of words of each text."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = raw > 32
    first = np.empty(len(raw), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    begin = np.cumsum(size) - size
    first[begin[size > 0]] = True
    first &= inside
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    span = np.diff(np.append(starts, len(raw)))
    offset = np.arange(starts[0], len(raw)) - np.repeat(starts, span)
    powers = np.multiply.accumulate(np.full(int(span.max()), _BASE, np.uint64))
    value = (raw[starts[0] :].astype(np.uint64) + np.uint64(1)) * powers[offset]
    value[~inside[starts[0] :]] = 0
    hashes = mix(np.add.reduceat(value, starts - starts[0]))
    seen = np.concatenate(([0], np.cumsum(first)))
    return hashes, seen[begin + size] - seen[begin]


def shingle_hashes(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles in order, and the number of shingles of each text."""
    words, n = word_hashes(texts)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    total = int(count.sum())
    if not total:
        return np.empty(0, np.uint64), count
    first = np.cumsum(n) - n  # of each text's words
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(total)
    length = np.repeat(np.minimum(n, k), count)
    out = np.zeros(total, np.uint64)
    for j in range(k):
        live = length > j
        out[live] = out[live] * _STEP + words[at[live] + j]
    return mix(out + length.astype(np.uint64)), count
