"""Words and lines of many texts at once, as numpy arrays inside a task.

A word is a run of characters other than space and U+0009 to U+000D. A block is some whole texts laid end to end as
UTF-8 bytes; all arrays below refer to positions in a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20
#: Values hashed in one stretch.
_HASHED = 1 << 18

_ODD = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return _power_row(_ODD, _HASHED), _power_row(pow(_ODD, -1, 1 << 64), _HASHED)


def _power_row(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base & _WRAP, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    return _hash_values(data, _BYTE_VALUE.__getitem__, starts, ends)


def hash_names(names: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of 64-bit names, in order and without overlap."""
    return _hash_values(names, mix, starts, ends)


def _hash_values(data: np.ndarray, value: Callable, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """From rolling sums over stretches of at most ``_HASHED`` values; a longer span is a stretch of its own."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _HASHED - 1, "right")))
        values = value(data[low : ends[j - 1]])
        if len(values) < _HASHED:
            power, inverse = _powers()
        else:
            power, inverse = _power_row(_ODD, len(values) + 1), np.ones(1, np.uint64)
        rolled = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=rolled[1:])
        out[i:j] = (rolled[ends[i:j] - low] - rolled[starts[i:j] - low]) * inverse[starts[i:j] - low]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Block:
    """Texts ``first`` to ``last`` (exclusive) of a batch: their bytes, and where each one starts and ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a number for each byte, by text."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def starts_character(self) -> np.ndarray:
        return (self.data & 0xC0) != 0x80


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Whole texts in blocks of about ``limit`` bytes; a null is an empty text."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    _, places, values = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        own = offsets[first : last + 1]
        yield Block(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


def lower_ascii(block: Block) -> Block:
    return Block(block.first, block.last, _LOWER[block.data], block.offsets)


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # which text of the block


def words(block: Block) -> Words:
    n = len(block.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none)
    space = _IS_SPACE[block.data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    edges = block.offsets
    before[edges[:-1][edges[:-1] < n]] = True
    after[edges[1:][edges[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(starts, ends, np.searchsorted(edges, starts, "right") - 1)


def lines(block: Block) -> Words:
    """The pieces between line feeds, empty ones included; an empty text has one."""
    breaks = np.flatnonzero(block.data == 10)
    starts = np.concatenate([block.offsets[:-1], breaks + 1])
    text = np.concatenate([np.arange(len(block.offsets) - 1), np.searchsorted(block.offsets, breaks, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.append(text[1:] != text[:-1], True)
    ends[last] = block.offsets[1:][text[last]]
    return Words(starts, ends, text)
