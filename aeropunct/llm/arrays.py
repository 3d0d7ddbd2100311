"""Whole batches of texts as numpy arrays: word bounds, hashes, windows.

The functions work on the UTF-8 bytes of many texts at once, so that a batch costs
a fixed number of array operations and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once inside a task; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUES = np.random.default_rng(20_011).integers(0, 2**64, 256, np.uint64, endpoint=False)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; null counts as empty."""
    texts = column.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, bounds, data = texts.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of text, texts kept whole."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = utf8(column)
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each maximal run of true bytes within a text."""
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds[1:] - 1] = inside[bounds[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word."""
    return runs(~_SPACE[data], offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, from one running sum over the batch."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[: len(data)], dtype=np.uint64, out=total[1:])
    own = (total[ends] - total[starts]) * inverse[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def window_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each window of ``k`` words inside one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = doc[:n] == doc[k - 1 :]
    at = np.flatnonzero(whole)
    out = h[at]
    for j in range(1, k):
        out = out * np.uint64(0x2545F4914F6CDD1D) + h[at + j]
    return mix(out), doc[at]


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` texts begins in a sorted array of text numbers, with the end."""
    return np.searchsorted(doc, np.arange(n + 1))
