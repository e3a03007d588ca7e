"""Word shingles of whole Arrow batches as numpy arrays, and MinHash signatures over them.

A text is a run of words, split at ASCII white space after A-Z is lowered. Its set holds a
64-bit hash for each run of five words; a text of fewer words has one hash for all of them;
a text without words has none. Everything is computed over a batch of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
# A piece of text that is hashed at once; longer texts are cut between words.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_random = np.random.default_rng(20240501)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTER = BYTE_VALUES.copy()
_LETTER[65:91] = _LETTER[97:123]
_PLACE = _random.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)
_COUNT = _random.integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_up = _powers(_BASE, PIECE)
_down = _powers(_BASE_INVERSE, PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each text starts and the last ends."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in slices of about ``size`` bytes of a text column, one row at least."""
    at = utf8(batch.column(column))[1]
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(at, at[low] + size, side="right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends; ``starts``: the first byte of every text."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = starts[(starts > 0) & (starts < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(
    data: np.ndarray, begin: np.ndarray, end: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """A hash of each span of bytes: a polynomial over their values, by differences of sums."""
    global _up, _down
    out = np.empty(len(begin), dtype=np.uint64)
    i = 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + PIECE, side="right")))
        low, high = int(begin[i]), int(end[j - 1])
        if high - low > len(_up):
            _up, _down = _powers(_BASE, high - low), _powers(_BASE_INVERSE, high - low)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(values[data[low:high]] * _up[: high - low], out=sums[1:])
        b, e = begin[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[e] - sums[b]) * _down[b] + (e - b).astype(np.uint64))
        i = j
    return out


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, repeats included, and where each text's hashes start."""
    data, at = utf8(column)
    begin, end = _words(data, at[:-1])
    words = hash_spans(data, begin, end, _LETTER)
    first = np.searchsorted(begin, at)
    n = np.diff(first)
    counts = np.where(n >= WIDTH, n - WIDTH + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    if not starts[-1]:
        return np.empty(0, np.uint64), starts
    # The first word of every shingle.
    lead = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], counts)
    size = np.repeat(np.minimum(n, WIDTH), counts)
    padded = np.concatenate([words, np.zeros(WIDTH, np.uint64)])
    out = _COUNT[size].copy()
    for k in range(WIDTH):
        term = padded[lead + k] * _PLACE[k]
        if n.size and n.min() < WIDTH:
            term[size <= k] = 0
        out += term
    return mix(out), starts


def sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, starts = shingles(column)
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        yield np.unique(hashes[a:b])


class MinHash:
    """``bands`` x ``rows`` universal hash functions over 32 bits, and their minima."""

    def __init__(self, bands: int, rows: int, seed: int):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = random.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.b = random.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
        self.fold = random.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)

    def signatures(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of minima for each set; every set must hold at least one hash."""
        out = np.empty((len(starts) - 1, len(self.a)), dtype=np.uint32)
        # Pieces that stay in the processor's cache, cut between sets.
        i, n = 0, len(starts) - 1
        while i < n:
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + 32768, side="right")) - 1)
            x = hashes[starts[i] : starts[j]].astype(np.uint32)
            cuts = (starts[i:j] - starts[i]).astype(np.intp)
            value = np.empty_like(x)
            for k in range(len(self.a)):
                np.multiply(x, self.a[k], out=value)
                np.add(value, self.b[k], out=value)
                out[i:j, k] = np.minimum.reduceat(value, cuts)
            i = j
        return out

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """A 64-bit key for each set and band, different from band to band."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64)
        band = np.arange(1, self.bands + 1, dtype=np.uint64) << np.uint64(40)
        return mix((mix(parts) * self.fold).sum(axis=2, dtype=np.uint64) + band).astype(np.int64)
