"""Word shingles of texts as sets of 64-bit hashes, inside a task.

Words are runs of characters other than space and the control characters 9 to 13, with A-Z lowered. A shingle is
``size`` words in a row; a text with fewer words has one shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, text of every word), in order."""
    spaced = pc.replace_substring_regex(pc.ascii_lower(texts.cast(pa.string())), r"[\x09-\x0D]", " ")
    split = pc.split_pattern(spaced, " ")
    coded = split.flatten().dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in coded.dictionary.to_pylist()], np.uint64)
    filled = np.array([bool(w) for w in coded.dictionary.to_pylist()], bool)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    keep = filled[index] if len(index) else np.zeros(0, bool)
    return hashes[index[keep]], row[keep]


def shingle_sets(texts: pa.Array, size: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of every text, sorted; offsets per text)."""
    words, row = word_hashes(texts)
    count = np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(len(texts), np.int64)
    first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    n = max(0, len(words) - size + 1)
    value, owner = np.zeros(n, np.uint64), row[:n]
    for k in range(size):
        value = mixed(value * FACTOR + words[k:k + n] + np.uint64(k + 1))
    inside = owner == row[size - 1:size - 1 + n] if n else np.zeros(0, bool)
    value, owner = value[inside], owner[inside]
    short = np.flatnonzero((count > 0) & (count < size))
    extra = np.array([int(whole(words[first[t]:first[t + 1]])) for t in short.tolist()], np.uint64)
    value, owner = np.concatenate([value, extra]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[fresh], minlength=len(texts)) if len(value) else np.zeros(len(texts), np.int64)
    return value[fresh], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def whole(words: np.ndarray) -> np.uint64:
    """The hash of a sequence that is shorter than a shingle."""
    value = np.full(1, len(words), np.uint64)
    for k in range(len(words)):
        value = mixed(value * FACTOR + words[k:k + 1] + np.uint64(1000 + k))
    return value[0]
