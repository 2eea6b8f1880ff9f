"""64-bit hashes of words and word grams, computed for whole Arrow batches.

A batch's texts lie in one byte buffer. Words are runs of bytes outside a separator set; A-Z
count as a-z. A word's hash is a polynomial over random byte values, taken from running sums, so
no Python step runs per word. Buffers are worked through in pieces of about ``PIECE`` bytes that
end at separators, so memory follows the longest word, not the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_STEPS = np.random.default_rng(20240607).integers(0, 2**64, 64, dtype=np.uint64) | _U(1)
_EXACT = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]


def separator_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the inclusive ``ranges``; bytes above 0x7F belong to words."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WHITE_SPACE = separator_table((0x20, 0x20), (0x09, 0x0D))
NOT_ALPHANUMERIC = separator_table((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(batch: pa.RecordBatch, text: str | int, size: int = 2 * PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``size`` bytes of text each, or one longer text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = np.cumsum(lengths), 0, 0
    while start < len(lengths):
        stop = max(start + 1, int(np.searchsorted(ends, total + size, "right")))
        yield batch.slice(start, stop - start)
        start, total = stop, ends[stop - 1]


class _Powers:
    forward = backward = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.forward) < n:
            for name, base in (("forward", _BASE), ("backward", pow(_BASE, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.forward, cls.backward


def _pieces(data: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(data):
        high, reach = min(low + PIECE, len(data)), PIECE
        while high < len(data) and not separator[data[high - 1]]:
            gaps = np.flatnonzero(separator[data[high : high + reach]])
            high = min(len(data), high + (int(gaps[0]) + 1 if len(gaps) else reach))
        yield low, high
        low = high


def _words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, values: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Hash, first byte and end of the words of one piece after the other."""
    for low, high in _pieces(data, separator):
        piece = data[low:high]
        word = ~separator[piece]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        cuts = offsets[np.searchsorted(offsets, low + 1) : np.searchsorted(offsets, high)] - low
        first[cuts] = word[cuts]  # a text begins here, whatever byte ended the one before
        last[cuts - 1] = word[cuts - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        forward, backward = _Powers.upto(max(len(piece), 2 * PIECE))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * forward[: len(piece)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * backward[starts]
        yield mix(value + (ends - starts).astype(np.uint64) * _STEPS[63]), starts + low, ends + low


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each text's first word (one more entry than texts)."""
    hashes, places = [], []
    for found, starts, _ in _words(data, offsets, separator, _FOLDED):
        hashes.append(found)
        places.append(starts)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def exact_words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash of every word as it is written, its first byte and end, and the index of each text's first word."""
    found = list(_words(data, offsets, separator, _EXACT))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    hashes, starts, ends = (np.concatenate(part) for part in zip(*found))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on, whatever text they belong to."""
    n = max(len(words) - k + 1, 0)
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += words[i : n + i] * _STEPS[i]
    return mix(total)


def text_of(first: np.ndarray) -> np.ndarray:
    """For every word the index of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
