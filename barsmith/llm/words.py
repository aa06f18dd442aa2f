"""Words of whole Arrow text columns and their 64-bit hashes, in NumPy inside tasks.

A batch of texts is one byte buffer with offsets, so words are found and hashed for many
documents at a time without a Python object per word. Work goes on in blocks of bounded bytes;
only a single text longer than a block makes a block longer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n seeded 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_FACTOR) + np.uint64(seed))


def _byte_values() -> np.ndarray:
    values = stream(17, 256)
    values[65:91] = values[97:123]  # A-Z hash as a-z
    return values


_BYTES = _byte_values()
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Bytes that are part of words: all but blanks, or digits, letters and everything beyond ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, 9, 10, 11, 12, 13]] = False
LETTERS_DIGITS = np.zeros(256, bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    LETTERS_DIGITS[_low:_high] = True


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n, BLOCK_BYTES).bit_length()
    if size not in _powers:
        _powers.clear()
        made = []
        for base in (_FACTOR, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[size] = tuple(made)
    return _powers[size]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, index, data = column.buffers()
    if index is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(index, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches cut into few rows each, for work that makes Python objects per row."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES, most: int = 2048) -> Iterator[tuple[int, int]]:
    """Ranges of at most `most` texts with at most limit bytes together; a longer text stands alone."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), low + most, n)
        yield low, high
        low = high


@dataclass
class Words:
    """Words of a block: text number, hash, and byte range in the block's bytes."""

    doc: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray


def hash_words(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> Words:
    """All words of the texts, in order; A-Z counts as a-z in the hash.

    A word's hash is a polynomial over its bytes modulo 2**64, read off prefix sums, then mixed.
    """
    n = len(offsets) - 1
    size = len(data) + n + 1
    buffer = np.full(size, 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    buffer[at] = data
    inside = keep[buffer].view(np.int8)
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    power, inverse = _power_tables(size)
    sums = _BYTES[buffer]
    sums *= power[:size]
    np.cumsum(sums, out=sums)
    value = (sums[end - 1] - sums[start - 1]) * inverse[start]
    doc = np.searchsorted(offsets[1:] + np.arange(1, n + 1), start, "left")
    shift = doc + 1
    return Words(doc, mix(value), start - shift, end - shift)


def shingles(words: Words, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every run of `size` words.

    A text with fewer words, but at least one, has one run: its whole sequence.
    """
    factors = stream(size, size) | np.uint64(1)
    h, doc = words.hash, words.doc
    n = len(h) - size + 1
    docs, values = [], []
    if n > 0:
        total = h[:n] * factors[0]
        for j in range(1, size):
            total += h[j : j + n] * factors[j]
        whole = doc[:n] == doc[size - 1 :]
        docs.append(doc[:n][whole])
        values.append(mix(total[whole]))
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        own = h[first[d] : first[d + 1]]
        total = (own * factors[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        docs.append(np.array([d]))
        values.append(mix(np.array([total], np.uint64)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    docs, values = np.concatenate(docs), np.concatenate(values)
    order = np.argsort(docs, kind="stable")
    return docs[order], values[order]
