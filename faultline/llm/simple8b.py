"""Simple-8b: ids in 64-bit words, each a 4-bit selector and 60 bits that hold as many ids as the widest allows.

Selectors 0 to 12 are rows of ``LANES`` (ids per word, bits per id). An id that needs more than 20 bits is an escape: its
word has selector 13 and the id alone in 60 bits. A word is only cut short at the end of a block, where the lanes left
over hold zeros; the block's count says how many ids are real. All words of one selector are decoded by one vector shift.
"""

from __future__ import annotations

import numpy as np

#: (ids per word, bits per id), widest packing first; the last row is the escape.
LANES = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (1, 60)]
WIDTHS = np.maximum(1, np.frexp(np.arange(1 << 16, dtype=np.float64))[1]).astype(np.int8)


def pack(ids: np.ndarray) -> np.ndarray:
    """Words of a block. At each position the selector with most ids is taken; positions are walked by jumps that are
    computed for all positions at once."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.uint64)
    values = ids.astype(np.uint64)
    bits = bit_widths(ids)
    best = np.full(n, len(LANES) - 1, np.int8)
    for selector in range(len(LANES) - 2, -1, -1):
        count, width = LANES[selector]
        np.copyto(best, np.int8(selector), where=runs(bits <= width, count))
    jumps = np.array([count for count, _ in LANES], np.int64)[best]
    starts = walk(jumps)
    chosen = best[starts]
    words = np.empty(len(starts), np.uint64)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for selector, (count, width) in enumerate(LANES):
        at = np.flatnonzero(chosen == selector)
        if len(at):
            lanes = padded[starts[at][:, None] + np.arange(count)]
            shifted = lanes << (np.arange(count, dtype=np.uint64) * np.uint64(width))
            words[at] = np.bitwise_or.reduce(shifted, axis=1) | (np.uint64(selector) << np.uint64(60))
    return words


def runs(fits: np.ndarray, count: int) -> np.ndarray:
    """Where ``count`` places in a row fit; places past the end do. Windows are joined by doubling."""
    n = len(fits)
    window = np.ones(n + 64, bool)
    window[:n] = fits
    length = 1
    while length < count:
        step = min(length, count - length)
        window = window[:-step] & window[step:]
        length += step
    return window[:n]


def bit_widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, one at least."""
    if len(ids) and ids.max() < len(WIDTHS):
        return WIDTHS[ids]
    return np.maximum(1, np.frexp(ids.astype(np.float64))[1]).astype(np.int8)


def walk(jumps: np.ndarray) -> np.ndarray:
    """Positions met from 0 when each position says how far the next one is."""
    steps, at, out, n = jumps.tolist(), 0, [], len(jumps)
    while at < n:
        out.append(at)
        at += steps[at]
    return np.array(out, np.int64)


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([count for count, _ in LANES], np.int64)[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) if len(counts) else 0, np.uint64)
    for selector, (count, width) in enumerate(LANES):
        at = np.flatnonzero(chosen == selector)
        if len(at):
            mask = np.uint64((1 << width) - 1)
            lanes = (words[at][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & mask
            out[starts[at][:, None] + np.arange(count)] = lanes
    return out[:n]
