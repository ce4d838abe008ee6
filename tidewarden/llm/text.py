"""Numpy helpers that run inside tasks: words of an Arrow text column and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words are runs of bytes other than space and tab to carriage return.
WORD_BREAKS = b" \t\n\x0b\x0c\r"
#: Text bytes handled at a time; bounds the arrays built beside a batch.
SLICE_BYTES = 4 << 20

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(WORD_BREAKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


class Words(NamedTuple):
    """Words of the texts of a slice: ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut where the texts of a cut reach ``limit`` bytes; a longer text stays whole."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        begin = 0
        while begin < len(batch):
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def words_of(column, lower: bool = False) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = _LOWER[data]
    inside = ~_BREAK[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hashes of the words, eight bytes a round."""
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(words.data) + 1,), "<u8", padded, 0, (1,))
    length = words.end - words.start
    hashes = mix64(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rows, at, left = np.arange(len(length)), words.start, length
    while len(rows):
        chunk = loads[at] & _LOW_BYTES[np.minimum(left, 8)]
        hashes[rows] = mix64(hashes[rows] ^ (chunk * np.uint64(0x9FB21C651E98DF25)))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return hashes


def run_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``size`` consecutive words, by the index of the first one.

    Runs that cross from one text into the next are included; see :func:`run_valid`.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, (seed * 0x632BE59BD9B4E019 + 1) % 2**64, np.uint64)
    for j in range(size):
        total *= np.uint64(0x9E6C63D0676A9A99)
        total += hashes[j : j + n]
    return mix64(total)


def run_valid(first: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which of the runs of :func:`run_hashes` stay inside one text."""
    n = n_words - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    fits = np.ones(n_words, bool)
    for text_end in range(1, size):
        # the words that are fewer than ``size`` from the end of their text
        at = first[1:] - text_end
        at = at[at >= first[:-1]]
        fits[at] = False
    return fits[:n]


def text_of(first: np.ndarray, n_words: int) -> np.ndarray:
    """The index of the text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n_words]
