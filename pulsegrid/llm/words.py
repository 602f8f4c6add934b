"""Words of a text and their 64-bit hashes, for whole Arrow batches at once.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. UTF-8 never uses these bytes inside a
longer character, so the bytes can be cut without decoding. Everything here runs inside Spark tasks
on one batch; memory follows the bytes of a batch, which ``text_slices`` bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20
_SEGMENT = 2 << 20

_U = np.uint64
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20_011)).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``limit`` bytes of text, or a single longer text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[places[0] : places[-1]], places - places[0]


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the number of its first word (one more at the end)."""
    inside = _IS_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over a random number per byte value, then mixed.

    Works through the words in segments of bounded bytes, so that a long text needs no more.
    """
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + _SEGMENT, "right")), at + 1)
        s, e = starts[at:to] - base, ends[at:to] - base
        n = int(e[-1])
        up, down = _power(max(n + 1, _SEGMENT + 1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[base : base + n]] * up[:n], out=sums[1:])
        hashes[at:to] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return hashes


def hash_windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; position i covers words i to i+width-1."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power(max(len(words) + 1, _SEGMENT + 1))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix64((sums[width:] - sums[:-width]) * down[:n] + _U(width))
