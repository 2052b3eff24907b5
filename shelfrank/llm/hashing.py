"""Words and word shingles of whole texts as 64-bit hashes, in NumPy over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts of a run; its arrays take some forty times that in a worker.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, dtype=_U), np.ones(1, dtype=_U)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        both = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, dtype=_U)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        _powers = both[0], both[1]
    return _powers


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, dtype=np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `limit` bytes; a longer text makes a run of its own."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word and the word offsets of each text; A-Z count as a-z."""
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    size = len(data)
    word = ~_BLANK[data]
    cut = np.zeros(size + 1, dtype=bool)
    cut[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:size]
    last[:-1] &= ~word[1:] | cut[1:size]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _power_tables(size + 1)
    total = np.zeros(size + 1, dtype=_U)
    np.cumsum((data + _U(1)) * power[:size], out=total[1:])
    value = (total[ends] - total[starts]) * inverse[starts]
    return mixed(value ^ ((ends - starts).astype(_U) << _U(48))), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per run of texts: index of its first text and the sorted distinct shingle hashes of each.

    A text of fewer than `width` words is one shingle; a text without words has none.
    """
    weight = mixed(np.arange(1, width + 1, dtype=_U) * _U(_BASE)) | _U(1)
    data, offsets = text_buffer(texts)
    for first, last in chunks(offsets):
        words, bounds = word_hashes(data, offsets[first : last + 1])
        rolled = np.zeros(max(len(words) - width + 1, 0), dtype=_U)
        for k in range(width):
            rolled += words[k : k + len(rolled)] * weight[k]
        rolled = mixed(rolled)
        sets = []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if high - low >= width:
                sets.append(np.unique(rolled[low : high - width + 1]))
            elif high > low:
                short = words[low:high] * weight[: high - low]
                sets.append(mixed(short.sum(dtype=_U, keepdims=True) + _U(high - low)))
            else:
                sets.append(rolled[:0])
        yield first, sets


def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All sets in a row and their offsets."""
    sizes = np.fromiter((len(s) for s in sets), dtype=np.int64, count=len(sets))
    values = np.concatenate(sets) if sets else np.empty(0, dtype=_U)
    return values, np.concatenate([[0], np.cumsum(sizes)])
