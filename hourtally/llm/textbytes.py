"""Hashes of the bytes of many texts at once, for functions that run inside tasks.

Texts arrive as Arrow columns. Their bytes are looked at as one array per block of
texts, so that Python's cost is per block and not per word. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# The odd radix of the polynomial hash, and mixing constants.
RADIX = 0x9E3779B97F4A7C15
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# Bytes looked at together. A longer text is a block of its own.
BLOCK = 1 << 21


class Block(NamedTuple):
    """Texts ``first`` to ``first + len(starts) - 1`` of a column."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * MIX_1
    values ^= values >> np.uint64(27)
    values *= MIX_2
    values ^= values >> np.uint64(31)
    return values


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each text starts (one more at the end)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_utf8())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """The column in blocks of whole texts of about ``size`` bytes."""
    if not len(column):
        return
    data, offsets = column_bytes(column)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        base = offsets[at]
        yield Block(at, data[base : offsets[upto]], offsets[at:upto] - base, offsets[at + 1 : upto + 1] - base)
        at = upto


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(RADIX))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64."""
    inverse = pow(RADIX, -1, 1 << 64)
    out = []
    for base in (RADIX, inverse):
        steps = np.full(size, np.uint64(base))
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class Spans:
    """Hashes of any spans of a byte array, each in constant time."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(12, int(len(data)).bit_length())
        powers, self._inverse = _powers(size)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values()[data] * powers[: len(data)], out=self._sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._inverse[starts]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))

    def grams(self, length: int) -> np.ndarray:
        """The hash of every span of one length."""
        count = len(self._sums) - length
        return mix((self._sums[length:] - self._sums[:count]) * self._inverse[:count])


@cache
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@cache
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


class Words(NamedTuple):
    """Words of a block: their places, and the first and the last + 1 of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray


def words(block: Block) -> Words:
    """Runs of bytes other than white space, A-Z in lower case; none crosses two texts."""
    data = _lower()[block.data]
    solid = ~_space()[data]
    filled = block.ends > block.starts
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    before[block.starts[filled]] = False
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    after[block.ends[filled] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, block.starts), np.searchsorted(starts, block.ends))


def word_hashes(found: Words) -> np.ndarray:
    return Spans(found.data).hashes(found.starts, found.ends)


def shingle_sets(block: Block, width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words.

    A text of fewer words has one, its whole word sequence; one without words has none.
    """
    found = words(block)
    each = word_hashes(found)
    whole = np.zeros(max(0, len(each) - width + 1), np.uint64)
    for k in range(width):
        factor = np.uint64(pow(RADIX, 2 * k + 1, 1 << 64))
        whole += each[k : k + len(whole)] * factor
    whole = mix(whole)
    for first, last in zip(found.first.tolist(), found.last.tolist(), strict=True):
        count = last - first
        if count >= width:
            some = np.sort(whole[first : last - width + 1])
            keep = np.empty(len(some), bool)
            keep[0] = True
            np.not_equal(some[1:], some[:-1], out=keep[1:])
            yield some[keep]
        elif count:
            total = np.uint64(count)
            for value in each[first:last]:
                total = mix(np.array([total ^ value]))[0]
            yield np.array([total])
        else:
            yield each[:0]
