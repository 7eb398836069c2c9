"""Texts to token ids inside a task: each distinct chunk of an Arrow batch is handled once, each distinct word is merged
once per Python worker.

A text is cut at single spaces. Such a cut is *safe* for a tokenizer if encoding the parts alone and joining the ids
gives the ids of the whole text; then equal parts are looked at once per batch, and a long text is never one call.
Where cuts are not safe the whole text goes to the library in one piece, however long it is.

* byte-level BPE: a space that follows a non-space starts a new word, so parts after the first keep their space.
  Runs of white space form words across cuts: texts with two neighbouring white-space characters, or with white space
  at the end, are encoded whole.
* word BPE: white space only separates words, lower casing and composition never reach across a space.
* sentencepiece: no piece of the vocabulary holds the space mark after another character (checked when the model is
  read), and every part gets the mark in front, as the whole text does. Texts with two neighbouring spaces, a space at
  the start or end, a space mark of their own, a NUL, or no character at all are encoded whole.

Special strings hold no space, so a cut never splits one.
"""

from __future__ import annotations

import gc
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from faultline.llm.pretokens import pretokens, to_symbols

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
BATCH_BYTES = 24 << 20
KNOWN_WORDS = 400_000
PARTS = 32_768
PLACES = 1 << 18
BATCH_SETTING, BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch", "12m"


class Library:
    """One tokenizer file: ``whole`` encodes texts by one call of the library, ``parts`` encodes distinct parts."""

    def __init__(self, path: str):
        self.known: dict[str, tuple[int, ...]] = {}
        self.numbers: dict[int, int] = {}  # one object per id, shared by all known words
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = (model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
            self.cuts = not any("▁" in piece for piece in pieces)
            self.unsafe = "^$|^ | $| {2}|▁|\\x00"
            self.keeps_space = False
            self.whole = self.parts = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_padding()
            tokenizer.no_truncation()
            self.before = pretokens(path)
            self.model = tokenizer.model
            self.cuts = True
            self.keeps_space = self.before.keeps_space
            self.unsafe = r"[\s\x{0b}\x{85}\p{Z}]{2}|[\s\x{0b}\x{85}\p{Z}]$" if self.keeps_space else None
            self.whole = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self.parts = self.by_words

    def by_words(self, parts: list[str]) -> list[tuple[int, ...]]:
        """The ids of each part; words met before are not merged again. A byte-level word alone is cut into itself, so a part
        that is a known word is not cut."""
        words, known, out = self.before.words, self.known, []
        whole = known if self.keeps_space else {}
        for part in parts:
            ids = whole.get(part)
            if ids is not None:
                out.append(ids)
                continue
            ids = ()
            for word in words(part):
                found = known.get(word)
                if found is None:
                    found = (word,) if isinstance(word, int) else self.merge(word)
                    if len(known) < KNOWN_WORDS:
                        known[word] = found
                ids += found
            out.append(ids)
        return out

    def merge(self, word: str) -> tuple[int, ...]:
        one = self.numbers.setdefault
        return tuple([one(token.id, token.id) for token in self.model.tokenize(to_symbols(word))])


@lru_cache(maxsize=4)
def library(path: str) -> Library:
    return Library(path)


def ragged(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of id lists."""
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=offsets[1:])
    flat: list[int] = []
    for ids in lists:
        flat += ids
    return np.array(flat, np.uint32), offsets


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``rows`` of a ragged array, one after the other. Places are worked out for about
    ``PLACES`` values at a time."""
    sizes = np.diff(offsets)[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    taken = np.empty(out[-1], values.dtype)
    edges = np.unique(np.append(np.searchsorted(out, np.arange(0, out[-1], PLACES)), len(rows)))
    for at, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        places = np.repeat(offsets[rows[at:end]] - out[at:end], sizes[at:end])
        places += np.arange(out[at], out[end])
        np.take(values, places, out=taken[out[at]:out[end]])
    return taken, out


def parts_of(texts: pa.Array, keeps_space: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct parts, index of each part of all texts, first part of each text), in order."""
    split = pc.split_pattern(texts, " ")
    words = split.flatten()
    first = split.offsets.to_numpy().astype(np.int64)
    first = first - first[0]
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    parts = coded.dictionary
    if keeps_space:
        opening = np.zeros(len(words), bool)
        opening[first[:-1][np.diff(first) > 0]] = True
        bare, at = np.unique(index[opening], return_inverse=True)
        index[opening] = len(parts) + at
        spaced = pc.binary_join_element_wise(pa.scalar(""), parts, " ")
        parts = pa.concat_arrays([spaced, parts.take(pa.array(bare))])
    return parts, index, first


def ids_of(parts: pa.Array, lib: Library) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts and their offsets. Only ``PARTS`` at a time are Python objects; the cyclic collector rests
    meanwhile: many small objects, no cycles."""
    collecting = gc.isenabled()
    gc.disable()
    try:
        runs = [ragged(lib.parts(parts.slice(at, PARTS).to_pylist())) for at in range(0, len(parts), PARTS)]
    finally:
        if collecting:
            gc.enable()
    if not runs:
        return ragged([])
    sizes = np.concatenate([np.diff(offsets) for _, offsets in runs])
    return np.concatenate([values for values, _ in runs]), np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def unsafe_rows(texts: pa.Array, lib: Library) -> np.ndarray:
    """Which texts must go to the library whole."""
    if lib.cuts and lib.unsafe and len(texts):
        return pc.match_substring_regex(texts, lib.unsafe).to_numpy(zero_copy_only=False)
    return np.full(len(texts), not lib.cuts)


def lengths(texts: pa.Array, path: str) -> np.ndarray:
    """The number of ids of each non-null text; ids are not kept."""
    lib = library(path)
    texts = texts.cast(pa.string())
    unsafe = unsafe_rows(texts, lib)
    out = np.zeros(len(texts), np.int64)
    parts, index, first = parts_of(texts.filter(pa.array(~unsafe)), lib.keeps_space)
    each = np.diff(ids_of(parts, lib)[1])
    total = np.zeros(len(index) + 1, np.int64)
    np.cumsum(each[index], out=total[1:])
    out[~unsafe] = np.diff(total[first])
    if unsafe.any():
        out[unsafe] = [len(ids) for ids in lib.whole(texts.filter(pa.array(unsafe)).to_pylist())]
    return out


def encode(texts: pa.Array, path: str, lib: Library | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of non-null ``texts``, as the library gives them for whole texts; ``lib`` may stand in for it."""
    lib = lib or library(path)
    texts = texts.cast(pa.string())
    unsafe = unsafe_rows(texts, lib)
    parts, index, first = parts_of(texts.filter(pa.array(~unsafe)), lib.keeps_space)
    values, offsets = ids_of(parts, lib)
    values, offsets = gather(values, offsets, index)
    offsets = offsets[first]
    if not unsafe.any():
        return values, offsets
    more, more_offsets = ragged(lib.whole(texts.filter(pa.array(unsafe)).to_pylist()))
    order = np.empty(len(texts), np.int64)
    order[~unsafe] = np.arange((~unsafe).sum())
    order[unsafe] = (~unsafe).sum() + np.arange(unsafe.sum())
    return gather(np.concatenate([values, more]), np.concatenate([offsets, offsets[-1] + more_offsets[1:]]), order)


def by_bytes(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES):
    """``batch`` in slices whose ``column`` holds about ``most`` bytes; a longer single value is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // most
    edges = [0, *(np.nonzero(np.diff(group))[0] + 1), len(sizes)]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with Arrow batches of a few megabytes unless the session sets their size itself. A batch waits whole, in the
    JVM and in the worker, while its slices are worked on, and Spark's own limit is 64 MB. Plans run later, so the setting
    stays; a longer single row is a batch of its own."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_SIZE)
    return docs
