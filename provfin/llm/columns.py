"""Texts of Arrow batches as flat byte arrays: words, rolling hashes, small batches.

Every function works on one Arrow slice of bounded size, inside a task. Nulls read as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once by one task, just under a power of two as tables of powers are; a longer text is a slice of its own.
SLICE_BYTES = (1 << 19) - (1 << 12)

#: Multipliers of the two rolling hashes, odd so that they can be inverted modulo 2**64.
BASES = (0x9E3779B97F4A7C17, 0xD6E8FEB86659FD93)


def _byte_class(outside: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes of words: all but the closed ranges given."""
    table = np.ones(256, bool)
    for low, high in outside:
        table[low : high + 1] = False
    return table


#: Bytes of ``[^\x20\x09-\x0D]+``.
SPACED = _byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``; upper-case letters count after lowering.
ALNUM = _byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: ASCII lower-casing of bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a slice holds about ``limit`` bytes of the column or one row."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()  # the worker may wait for its next task for long


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one entry more than texts)."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (one entry more than texts)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    mask = inside[data]
    begin, last = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    begin[edges] = mask[edges]
    edges = offsets[1:][offsets[1:] > 0] - 1
    last[edges] = mask[edges]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, n of each at least."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        made = []
        for base in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            made.append(np.multiply.accumulate(run))
        _POWERS[which] = (made[0], made[1])
    return _POWERS[which]


_SEEDS = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[1 - k])) for k in (0, 1)]


class Rolling:
    """Hash of any span of a sequence of 64-bit values in constant time (polynomial, modulo 2**64, then mixed)."""

    def __init__(self, values: np.ndarray, which: int = 0):
        power, self.inverse = _powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.sums[ends] - self.sums[starts]
        out *= self.inverse[starts]
        out += (ends - starts).astype(np.uint64) * np.uint64(BASES[0])
        return mix(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    return Rolling(_SEEDS[which][data], which).spans(starts, ends)


def hash_words(text_words: list[bytes], which: int = 0) -> np.ndarray:
    """The same hash for words given one by one."""
    lengths = np.array([len(w) for w in text_words], np.int64)
    ends = np.cumsum(lengths)
    return word_hashes(np.frombuffer(b"".join(text_words), np.uint8), ends - lengths, ends, which)


def fresh(names: list[str], *wanted: str) -> list[str]:
    """The wanted column names, with underscores added while they are taken."""
    taken = {n.lower() for n in names}
    out = []
    for name in wanted:
        while name in taken:
            name += "_"
        out.append(name)
    return out
