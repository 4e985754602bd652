"""Vectorised words: cut UTF-8 bytes into runs of one character class and hash each run, without a Python loop.

The hash of a run is a polynomial of its bytes modulo 2**64, read off a running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SEPARATOR, WORD, MARK = 0, 1, 2

#: Texts are joined up to so many bytes before they are cut; a longer text is cut alone.
CHUNK = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _classes(marks: bool) -> np.ndarray:
    table = np.full(256, MARK if marks else SEPARATOR, np.uint8)
    table[0x80:] = WORD
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        table[low : high + 1] = WORD
    table[:0x21] = SEPARATOR
    table[0x7F] = SEPARATOR
    return table


def _fold() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


CLASSES = {False: _classes(False), True: _classes(True)}
FOLD = _fold()
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[FOLD]


@cache
def _powers(log: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(1 << log, _BASE, np.uint64), np.full(1 << log, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def cut(data: np.ndarray, ends: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, hashes, classes) of the runs in data; ends are where texts end, and no run spans two.

    Words are runs of digits, letters and bytes from 0x80; A-Z counts as a-z. With marks, runs of other visible
    characters count too.
    """
    kinds = CLASSES[marks][data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    edge[ends] = True
    at = np.flatnonzero(edge)
    keep = kinds[at[:-1]] != SEPARATOR
    starts, stops = at[:-1][keep], at[1:][keep]
    up, down = _powers(max(1, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=total[1:])
    return starts, stops, mix((total[stops] - total[starts]) * down[starts]), kinds[starts]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, ends of the texts in them) of a column without nulls, some rows at a time."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first + 1 : end + 1] - offsets[first]
        first = end
