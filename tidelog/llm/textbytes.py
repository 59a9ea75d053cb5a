"""Arrow text columns as byte arrays: words, hashes and shingles without a Python loop over rows.

A word is a run of ASCII letters, digits and bytes of other scripts; everything else separates.
Hashes are polynomials modulo 2**64 of the bytes, taken from one running sum, and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)

_codes = np.arange(256)
IS_WORD = (
    ((_codes >= 48) & (_codes <= 57)) | ((_codes >= 65) & (_codes <= 90)) | ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128)
)

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose text stays near ``max_bytes`` (one longer row is a run of its own)."""
    _, offsets = column_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Powers that a worker keeps between slices; longer runs are made of them for one slice and dropped.
_KEPT_POWERS = 2_000_000


def _power(kind: str, n: int) -> np.ndarray:
    base = _BASE if kind == "up" else _BASE_INVERSE
    have = _powers[kind]
    if len(have) < min(n, _KEPT_POWERS):
        steps = np.full(max(min(n, _KEPT_POWERS), min(2 * len(have), _KEPT_POWERS)), base, np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.multiply.accumulate(steps)
    if n <= len(have):
        return have
    return np.concatenate([have * np.uint64(pow(int(base), low, 2**64)) for low in range(0, n, len(have))])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; equal bytes give equal hashes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data))[: len(data)], out=total[1:])
    down = _power("down", len(data) + 1)
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; ``is_word`` has the bytes that words consist of."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = is_word[data]
    before = np.concatenate(([False], inside[:-1]))
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after = np.concatenate((inside[1:], [False]))
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingles(data: np.ndarray, offsets: np.ndarray, words: int, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every different run of ``words`` words; a shorter text is one run."""
    starts, ends, rows = word_spans(data, offsets, is_word)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = span_hashes(data, starts, ends)
    n = len(rows)
    padded_rows = np.concatenate((rows, np.full(words, -1)))
    padded = np.concatenate((hashes, np.zeros(words, np.uint64)))
    run = np.zeros(n, np.uint64)
    for k in range(words):
        same = padded_rows[k : k + n] == rows
        run = run * _STEP + np.where(same, padded[k : k + n], np.uint64(0))
    first = np.concatenate(([True], rows[1:] != rows[:-1]))
    whole = padded_rows[words - 1 : words - 1 + n] == rows
    take = whole | first
    run, rows = mix(run[take]), rows[take]
    key = run + mix(rows.astype(np.uint64) + np.uint64(1))
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return rows[at], run[at], counts
