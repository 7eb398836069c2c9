"""BPE encoding and decoding as streaming transducers.

Encoding. A merge list decides a token boundary from a bounded stretch of the symbols to its right. ``lookahead`` computes
a sufficient stretch from the list: a rule (u, v) can take the end of a token away from an earlier rule, and what keeps v
from being formed is again a rule of lower rank whose left part ends v, and so on; ranks fall along such a chain, so the
longest chain comes out of one pass over the rules in rank order. ``Encoder.stream`` then holds a window of the longest
token plus that stretch, merges it, and gives out every token that ends before the stretch: those tokens are the ones of
the whole word, however long it is. Memory is the window.

Decoding. ``Decoder`` takes ids in any portions. For a byte-level file it joins the bytes of the tokens and gives out text
as soon as UTF-8 characters are complete, replacing what cannot be one; for a file without a decoder tokens are joined by
spaces, which is what the library does.

Cases: a NULL text is the empty text (no ids, empty decoding); repeated rows are coded each; an empty table gives an
empty result; a very long word or text is coded in windows; special strings in a text are their own ids; other columns
are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import Library, by_bytes, encode
from faultline.llm.pretokens import BYTES, pretokens, to_symbols

WINDOW_IDS = 1 << 16
SLICE_BYTES = 8 << 20


def lookahead(merges: list[tuple[str, str]], size) -> int:
    """Symbols to the right of a boundary that can decide it. ``size`` gives the symbols of a token."""
    reach: dict[str, int] = {}  # of the rules so far, by their left part: how far to the right they look
    ends: dict[str, tuple[str, ...]] = {}  # what a token ends with while it is being formed
    most = 0
    for left, right in merges:
        tail = ends.get(right, (right,))
        far = size(right) + max((reach.get(x, 0) for x in tail), default=0)
        reach[left] = max(reach.get(left, 0), far)
        ends[left + right] = tuple(dict.fromkeys((*ends.get(left + right, (left + right,)), *tail)))
        most = max(most, far)
    return most


class Encoder:
    """Streaming merges of one tokenizer file."""

    def __init__(self, path: str):
        before = pretokens(path)
        self.suffix, self.vocab = before.suffix, before.vocab
        self.ranks = {pair: rank for rank, pair in enumerate(before.merges)}
        mark = len(self.suffix)

        def size(token: str) -> int:
            return len(token) - mark if mark and token.endswith(self.suffix) else len(token)

        self.size = size
        self.longest = max(map(size, self.vocab))
        self.ahead = lookahead(before.merges, size)

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges within ``symbols``: lowest rank first, leftmost first."""
        ranks = self.ranks
        worst = len(ranks)
        while len(symbols) > 1:
            best, pair = worst, None
            for found in zip(symbols, symbols[1:]):  # noqa: B905
                rank = ranks.get(found, worst)
                if rank < best:
                    best, pair = rank, found
            if pair is None:
                break
            left, right = pair
            out, n, last = [], 0, len(symbols) - 1
            while n <= last:
                if n < last and symbols[n] == left and symbols[n + 1] == right:
                    out.append(left + right)
                    n += 2
                else:
                    out.append(symbols[n])
                    n += 1
            symbols = out
        return symbols

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Ids of one word from its symbols, each given out once no later symbol can change it."""
        width, window, source = self.longest + self.ahead, [], iter(symbols)
        held = next(source, None)
        while held is not None:
            following = next(source, None)
            window.append(held if following is not None else held + self.suffix)
            held = following
            if held is None:
                yield from map(self.vocab.__getitem__, self.merge(window))
            elif len(window) >= 2 * width:
                kept, done = len(window) - self.ahead, 0
                for token in self.merge(window):
                    if done + self.size(token) > kept:
                        break
                    done += self.size(token)
                    yield self.vocab[token]
                window = window[done:]

    def word(self, word: str) -> tuple[int, ...]:
        symbols = to_symbols(word)
        if len(symbols) > 2 * (self.longest + self.ahead):
            return tuple(self.stream(symbols))
        parts = list(symbols)
        parts[-1] += self.suffix
        return tuple([self.vocab[token] for token in self.merge(parts)])


class Streaming(Library):
    """The parts of texts coded by the transducer, in place of the library."""

    def __init__(self, path: str):
        self.known = {}
        self.before, self.cuts = pretokens(path), True
        self.keeps_space = self.before.keeps_space
        self.unsafe = r"[\s\x{0b}\x{85}\p{Z}]{2}|[\s\x{0b}\x{85}\p{Z}]$" if self.keeps_space else None
        self.merge = Encoder(path).word
        self.whole = self.parts = self.by_words


@lru_cache(maxsize=2)
def streaming(path: str) -> Streaming:
    return Streaming(path)


class Decoder:
    """Ids to text in portions; ``finish`` gives out what is still held."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        self.joined = spec.get("decoder") is None
        before = pretokens(path)
        named = {i: token for token, i in [*before.vocab.items(), *before.special.items()]}
        names = [named.get(i, "") for i in range(max(named) + 1)]
        self.tokens = names if self.joined else [
            bytes(BYTES[c] for c in token) if all(c in BYTES for c in token) else token.encode() for token in names]
        self.reset()

    def reset(self) -> None:
        self.machine, self.started = codecs.getincrementaldecoder("utf-8")("replace"), False

    def push(self, ids: list[int]) -> str:
        tokens = self.tokens
        if not self.joined:
            return self.machine.decode(b"".join([tokens[i] for i in ids]))
        out = " ".join([tokens[i] for i in ids])
        if self.started and ids:
            out = " " + out
        self.started = self.started or bool(ids)
        return out

    def finish(self) -> str:
        return "" if self.joined else self.machine.decode(b"", True)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def code_texts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", outputs: bool = False) -> DataFrame:
    """Per row its number of ids and the digests of ids and decoded text; with ``outputs`` also ids and text."""

    def run(batches):
        machine, decimals = decoder(path), [str(i) for i in range(len(decoder(path).tokens))]
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                ids, offsets = encode(rows.column(1), path, streaming(path))
                counts, of_ids, of_text, texts = [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    machine.reset()
                    ids_digest, text_digest, parts = hashlib.sha256(), hashlib.sha256(), []
                    for at in range(a, b, WINDOW_IDS):
                        window = ids[at:min(b, at + WINDOW_IDS)].tolist()
                        ids_digest.update(((" " if at > a else "") + " ".join([decimals[i] for i in window])).encode())
                        parts.append(machine.push(window))
                        text_digest.update(parts[-1].encode())
                        if not outputs:
                            parts = []
                    parts.append(machine.finish())
                    text_digest.update(parts[-1].encode())
                    counts.append(b - a)
                    of_ids.append(ids_digest.hexdigest())
                    of_text.append(text_digest.hexdigest())
                    texts.append("".join(parts))
                out = [rows.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)]
                if outputs:
                    out += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int64())),
                            pa.array(texts, pa.string())]
                yield pa.record_batch(out, names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * outputs
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<bigint>, decoded string" * outputs
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)
