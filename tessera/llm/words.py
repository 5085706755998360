"""Words, word hashes and shingles of whole texts, a batch of texts at a time.

A batch of texts is one buffer of UTF-8 bytes with offsets, as Arrow holds it, so words are
found and hashed by array operations and no text is cut. A word is a run of bytes other than
space and the controls 9 to 13. A word's hash is the sum of one random 64-bit value for each pair
of a byte and its place in the word (tabulation hashing), taken from one running sum, then
mixed. Unlike a polynomial modulo a power of two it has no pattern of bytes on which different words meet:
two different words share a hash with a chance of 2^-64, whatever their length.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Seed of the byte values, the odd base of rolling hashes, and the step from one place
# in a word to the next; values of the first places are looked up, those of later ones computed.
SEED = 20240229
BASE = 0x9E3779B97F4A7C15 | 1
STEP = np.uint64(0xC2B2AE3D27D4EB4F)
TABLE_PLACES = 64
CHUNK_BYTES = 1 << 20
HASH_BYTES = 1 << 18

MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a published generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def byte_values(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_case`` A-Z share those of a-z."""
    values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def separators() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[32, *range(9, 14)]] = True
    return table


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)
        self.inverse = pow(BASE, -1, 1 << 64)

    def upto(self, n: int) -> Powers:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, factor in (("up", BASE), ("down", self.inverse)):
                steps = np.full(size, np.uint64(factor))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self


def give_back() -> None:
    """Return freed memory of a worker process to the system: a worker outlives its task, and what one stage took is missing in the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        # other C libraries have no such call
        pass


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """Row ranges (first, last) whose bytes stay near ``size``; one row is never cut."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class WordReader:
    """Word spans and hashes of a buffer of texts."""

    def __init__(self, fold_case: bool = False):
        self.values = byte_values(fold_case)
        places = np.arange(TABLE_PLACES, dtype=np.uint64)[:, None]
        self.table = mix(self.values + places * STEP).ravel()
        self.gap = separators()
        self.powers = Powers()

    def spans(self, raw: np.ndarray, offsets: np.ndarray):
        """(starts, ends, row bounds): words of row r are those from bounds[r] to bounds[r + 1]."""
        n = len(raw)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        inside = ~self.gap[raw]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begin[edges] = inside[edges]
        over = inside.copy()
        over[:-1] &= ~inside[1:]
        over[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(over) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def hashes(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span; spans ascend and may leave bytes between them out. Read in blocks of ``HASH_BYTES``, or of one longer span."""
        out = np.zeros(len(starts), dtype=np.uint64)
        first = 0
        while first < len(starts):
            last = max(int(np.searchsorted(ends, starts[first] + HASH_BYTES, side="right")), first + 1)
            out[first:last] = self._block(raw, starts[first:last], ends[first:last])
            first = last
        return out

    def _block(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        base = starts[0]
        body = raw[base : ends[-1]]
        place = np.arange(len(body)) - np.repeat(starts - base, np.diff(np.r_[starts, ends[-1]]))
        terms = self.table[(np.minimum(place, TABLE_PLACES - 1) << 8) | body]
        far = np.flatnonzero(place >= TABLE_PLACES)
        terms[far] = mix(self.values[body[far]] + place[far].astype(np.uint64) * STEP)
        total = np.zeros(len(body) + 1, dtype=np.uint64)
        np.cumsum(terms, out=total[1:])
        return mix(total[ends - base] - total[starts - base])

    def rows(self, column: pa.Array):
        """For each text in turn, its word hashes."""
        raw, offsets = text_buffer(column)
        for first, last in chunks(offsets):
            part = raw[offsets[first] : offsets[last]]
            starts, ends, bounds = self.spans(part, offsets[first : last + 1] - offsets[first])
            hashed = self.hashes(part, starts, ends)
            for r in range(last - first):
                yield hashed[bounds[r] : bounds[r + 1]]


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values, in order."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        out *= np.uint64(BASE)
        out += hashes[j : j + size]
    return mix(out)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word shingles in order; of fewer words, the whole sequence as one."""
    if 0 < len(hashes) < n:
        return rolling(hashes, len(hashes))
    return rolling(hashes, n)
