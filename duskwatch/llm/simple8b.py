"""Simple-8b word-aligned coding of ids, vectorised over blocks.

A 64-bit word holds a selector in its top four bits and 60 bits of payload. Selector k < 14 packs
COUNTS[k] values of BITS[k] bits each; the last word of a block may hold fewer values than its selector
allows, the rest of its payload is zero. Selector 15 is an escape: its payload is a place in the escape
list, which holds values of 2^60 and more as they are. Values are coded in blocks of BLOCK values, and the word offset of every block is
kept, so all blocks are decoded side by side and any block can be decoded alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 128
# Fixed values of the coding: how many values a selector packs, and their width.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0, 60], np.uint64)
ESCAPE = 15
_LIMITS = np.array([1 << int(b) for b in BITS[:14]], np.uint64)
_PAYLOAD = np.uint64((1 << 60) - 1)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8)


def _widths(values: np.ndarray) -> np.ndarray:
    """The narrowest selector of every value, one byte each; 14 for an escape."""
    if values.max() < len(_SMALL):
        return _SMALL[values]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.int8)


def _selectors(width: np.ndarray, block: int) -> np.ndarray:
    """For every place, by block, the selector that packs most of what follows in its block.

    It needs the widest value among the next COUNTS[k]: the greater one of two overlapping windows, whose length is a power of two.
    """
    blocks = -(-len(width) // block)
    rows = np.zeros((blocks, block), np.int8)
    rows.ravel()[:len(width)] = width
    best = np.where(rows == 14, np.int8(ESCAPE), np.int8(13))
    widest, length = np.zeros((blocks, block + int(COUNTS[0])), np.int8), 1  # nothing lies behind a block
    widest[:, :block] = rows
    for k in range(12, -1, -1):
        count = int(COUNTS[k])
        while 2 * length <= count:
            widest[:, :-length] = np.maximum(widest[:, :-length], widest[:, length:])
            length *= 2
        best[np.maximum(widest[:, :block], widest[:, count - length:count - length + block]) <= k] = k
    return best


def _alike(selector: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of one selector and number of values together: their places, and the values' number in the word and lowest bit, as columns."""
    kind = selector.astype(np.uint16) << np.uint16(6) | count.astype(np.uint16)
    order = np.argsort(kind, kind="stable")
    kind = kind[order]
    begins = np.flatnonzero(np.diff(kind)) + 1
    for words, k in zip(np.split(order, begins), kind[np.append(0, begins)].tolist()):
        number = np.arange(k & 63)[:, None]
        yield words, number, number.astype(np.uint64) * BITS[k >> 6]


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offset of each block's first word, escaped values)."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    width = _widths(values)
    # the selector to use if a word began here: the one that packs most of what follows in the block
    best = _selectors(width, block).ravel()[:n]
    # walk all blocks at once, word by word
    starts = np.zeros(n, bool)
    at = np.arange(0, n, block)
    ends = np.minimum(at + block, n)
    while len(at):
        starts[at] = True
        at = at + COUNTS[best[at]]
        on = at < ends
        at, ends = at[on], ends[on]
    begun = np.flatnonzero(starts)
    owners = begun // block
    block_end = np.minimum((owners + 1) * block, n)
    selector = best[begun]
    count = np.minimum(COUNTS[selector], block_end - begun)
    words = selector.astype(np.uint64) << np.uint64(60)
    escaped = selector == ESCAPE
    packed = values
    if escaped.any():
        packed = values.copy()
        packed[begun[escaped]] = np.arange(escaped.sum(), dtype=np.uint64)
    for at, number, shift in _alike(selector, count):
        words[at] |= np.bitwise_or.reduce(packed[begun[at] + number] << shift, axis=0)
    offsets = np.searchsorted(owners, np.arange(owners[-1] + 1)).astype(np.uint32)
    return words, offsets, values[begun[escaped]]


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The values, as uint64."""
    if n == 0:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    payload = words & _PAYLOAD
    full = COUNTS[selector]
    before = np.concatenate([[0], np.cumsum(full)])[:-1]
    per_block = np.diff(np.append(offsets.astype(np.int64), len(words)))
    inside = before - np.repeat(before[offsets], per_block)
    begin = inside + np.repeat(np.arange(len(offsets)) * block, per_block)
    count = np.minimum(full, np.minimum((begin // block + 1) * block, n) - begin)
    out, mask = np.empty(n, np.uint64), (np.uint64(1) << BITS[selector]) - np.uint64(1)
    for at, number, shift in _alike(selector, count):
        out[begin[at] + number] = payload[at] >> shift & mask[at]
    escaped = selector == ESCAPE
    out[begin[escaped]] = escapes[payload[escaped].astype(np.int64)]
    return out
