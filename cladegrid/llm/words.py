"""Words of many texts at once: byte classes, word codes and window codes in NumPy, for use inside Arrow maps.

Texts are taken as UTF-8 bytes. Both word definitions used here separate words by single ASCII bytes only, so bytes
of multi-byte characters never need decoding. A word's code is a 64-bit polynomial over random byte values, mixed at
the end; a window's code is a polynomial over word codes. A null text has no words, like an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of a batch are worked on in slices of about so many bytes (one text at least), which bounds memory.
SLICE_BYTES = 1 << 20

_FACTOR, _WINDOW_FACTOR = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def give_back() -> None:
    """Return unused memory to the system, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _table(outside: bytes) -> np.ndarray:
    inside = np.ones(256, bool)
    inside[np.frombuffer(outside, np.uint8)] = False
    return inside


# [^\x20\x09-\x0D]+
NON_BLANK = _table(b" \t\n\x0b\x0c\r")
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z was lower-cased
LETTERS_DIGITS = _table(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))


class Words(NamedTuple):
    """Words of the rows ``row`` to ``row + len(bounds) - 2``; row i has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    row: int
    data: np.ndarray  # bytes
    first: np.ndarray  # of each word, in data
    last: np.ndarray  # exclusive
    bounds: np.ndarray
    codes: np.ndarray


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + np.uint64(salt)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the factor and of its inverse modulo 2 ** 64, as far as a slice needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            for name, factor in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 1 << 64))):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_POWERS = _Powers()


def text_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a string column: first row, bytes, offsets of the rows in them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last (exclusive) byte of each word, and the word bounds of each row."""
    within = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = within & edge[:-1], within & edge[1:]
    begins[1:] |= within[1:] & ~within[:-1]
    ends[:-1] |= within[:-1] & ~within[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, offsets)


def word_slices(column: pa.Array, inside: np.ndarray, lower: bool) -> Iterator[Words]:
    """Words and their codes, slice by slice; ``lower`` takes A-Z as a-z."""
    values = _BYTE_VALUES.copy()
    if lower:
        values[65:91] = values[97:123]
    for row, data, offsets in text_slices(column):
        first, last, bounds = find_words(data, offsets, inside)
        _POWERS.reach(len(data))
        terms = values[data] * _POWERS.up[: len(data)]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        codes = mix((sums[last] - sums[first]) * _POWERS.down[first]) if len(first) else np.zeros(0, np.uint64)
        yield Words(row, data, first, last, bounds, codes)


def window_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """Code of each run of ``length`` word codes, by its first word; runs over the end of a row are included."""
    if len(codes) < length:
        return np.zeros(0, np.uint64)
    done, size, block, step = None, 0, codes, 1
    while True:
        if length & step:
            if done is None:
                done = block
            else:
                n = len(codes) - size - step + 1
                done = done[:n] * np.uint64(pow(_WINDOW_FACTOR, step, 1 << 64)) + block[size : size + n]
            size += step
        if size == length:
            return mix(done, length)
        block = block[:-step] * np.uint64(pow(_WINDOW_FACTOR, step, 1 << 64)) + block[step:]
        step *= 2


def window_starts(bounds: np.ndarray, length: int) -> np.ndarray:
    """Word positions at which a window of ``length`` words fits inside its row."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(len(ends))
    return np.flatnonzero(at + length <= ends)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n words lie in any of the windows."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys with the run bounds, from batches sorted by those (non-null) keys."""
    held: list[pa.RecordBatch] = []

    def cuts(table: pa.Table) -> np.ndarray:
        differs = np.zeros(max(0, table.num_rows - 1), bool)
        for key in keys:
            values = table.column(key).to_numpy()
            differs |= values[1:] != values[:-1]
        return np.flatnonzero(differs) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        at = cuts(table)
        if len(at):
            yield table.slice(0, at[-1]), np.concatenate([[0], at])
            held = table.slice(at[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.concatenate([[0], cuts(table), [table.num_rows]])
