"""Token files, counts, transducer and packing against the libraries on whole texts."""

import hashlib
import random
import tracemalloc
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from faultline.llm import queries, simple8b
from faultline.llm.chunks import BATCH_SETTING, BATCH_SIZE, encode, gather
from faultline.llm.packing import pack_documents, place
from faultline.llm.pretokens import pretokens, to_symbols
from faultline.llm.token_counts import token_counts
from faultline.llm.token_files import read_tokens, write_tokens
from faultline.llm.transducer import Decoder, Encoder, code_texts
from faultline.session import run_dir
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
STRANGE = st.text(st.one_of(st.sampled_from(" \n\t'abcSTtherLLé́ΣİǅÅ0٣😀▁<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)


@lru_cache
def whole(path):
    if path.endswith(".model"):
        return sentencepiece.SentencePieceProcessor(model_file=path).encode
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD, PIECE])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(STRANGE, max_size=5))
def test_chunks_give_what_whole_texts_give(path, texts):
    ids, offsets = encode(pa.array(texts, pa.string()), path)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [list(whole(path)(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70000), st.integers(0, 2**32 - 1)), max_size=300))
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert simple8b.unpack(simple8b.pack(ids), len(ids)).tolist() == ids.tolist()


def test_simple8b_packs_small_ids_densely():
    assert len(simple8b.pack(np.ones(6000, np.uint32))) == 100
    assert len(simple8b.pack(np.full(10, 2**31, np.uint32))) == 10  # escapes


def test_token_files(spark, sf, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_token_files"](spark, sf).collect()}
    tokenizer, start = whole(BYTE), 0
    assert sorted(got) == sorted(texts)
    for doc_id in sorted(texts):
        ids = np.array([*tokenizer(texts[doc_id]), 2], "<u4")
        row = got[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows(spark, odd, none):
    path = run_dir(spark, "t")
    write_tokens(odd, path, BYTE, end_id=2, block_ids=100)
    got = read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 3, 4, 5, 7, 8, 9, 10, 11, 12]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    assert got[1]["ids"] == got[2]["ids"] == [2]
    for row, text in zip(odd.orderBy("doc_id").collect(), got, strict=True):
        assert text["ids"] == [*whole(BYTE)(row["text"] or ""), 2]
    empty = run_dir(spark, "t")
    write_tokens(none, empty, BYTE, end_id=2)
    assert read_tokens(spark, empty).count() == 0


def test_token_files_are_written_from_small_batches(spark, odd):
    set_before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        write_tokens(odd, run_dir(spark, "t"), BYTE, end_id=2)
        assert spark.conf.get(BATCH_SETTING, None) == BATCH_SIZE
    finally:
        spark.conf.unset(BATCH_SETTING) if set_before is None else spark.conf.set(BATCH_SETTING, set_before)


def test_gather_holds_little_beside_its_result():
    values, offsets = np.arange(400, dtype=np.uint32), np.array([0, 30, 30, 100, 400])
    rows = np.tile(np.array([3, 0, 1, 2, 3]), 20_000)
    tracemalloc.start()
    try:
        got, bounds = gather(values, offsets, rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    kept = got.nbytes + bounds.nbytes
    assert peak < 1.5 * kept
    want = [values[offsets[r]:offsets[r + 1]] for r in rows]
    assert (got == np.concatenate(want)).all() and bounds.tolist() == np.cumsum([0, *map(len, want)]).tolist()
    assert [x.tolist() for x in gather(values[:0], np.zeros(1, np.int64), rows[:0])] == [[], [0]]


@settings(max_examples=300, deadline=None)
@given(text=STRANGE)
def test_a_byte_level_word_is_cut_into_itself(text):
    before = pretokens(BYTE)
    for part in [text, *text.split(" ")]:
        for word in before.words(part):
            assert isinstance(word, int) or before.words(word) == [word]


def test_token_counts(spark, sf, texts, odd, none):
    for r in queries.QUERIES["op9_token_counts"](spark, sf).collect():
        n = len(whole(PIECE)(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)
    want = sorted((r["doc_id"] or 0, len(whole(PIECE)(r["text"] or ""))) for r in odd.collect())
    for path in (BYTE, WORD, PIECE):
        want = sorted((r["doc_id"] or 0, len(whole(path)(r["text"] or ""))) for r in odd.collect())
        assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in token_counts(odd, path).collect()) == want
    assert token_counts(none, PIECE).count() == 0


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_transducer_equals_the_library(path):
    encoder, model, rng = Encoder(path), Tokenizer.from_file(path).model, random.Random(5)
    pieces = [w.removesuffix("</w>") for w in list(encoder.vocab)[:4000]]
    for n in range(60):
        symbols = "".join(rng.choices(pieces, k=rng.choice([1, 5, 60, 900]))) if n % 2 else to_symbols(
            "".join(rng.choice("aehinrstouldßéxyz") for _ in range(rng.choice([3, 400, 6000]))))
        assert list(encoder.stream(symbols)) == [t.id for t in model.tokenize(symbols)]


def test_transducer_emits_before_the_end():
    encoder = Encoder(WORD)
    seen = 0

    def source():
        nonlocal seen
        for _ in range(100_000):
            seen += 1
            yield "a"

    next(encoder.stream(source()))
    assert seen <= 2 * (encoder.longest + encoder.ahead) + 2


def test_decoder_in_portions():
    tokenizer = Tokenizer.from_file(BYTE)
    ids = tokenizer.encode("naïve 😀 日本 text", add_special_tokens=False).ids
    for ids in (ids, ids[1:], ids[:-1], ids[::-1]):
        decoder = Decoder(BYTE)
        assert "".join([*(decoder.push([i]) for i in ids), decoder.finish()]) == tokenizer.decode(ids, skip_special_tokens=False)
    tokenizer, decoder = Tokenizer.from_file(WORD), Decoder(WORD)
    ids = tokenizer.encode("Some words, and 12", add_special_tokens=False).ids
    assert "".join([*(decoder.push([i]) for i in ids), decoder.finish()]) == tokenizer.decode(ids, skip_special_tokens=False)


def digests(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_bpe_query_and_odd_rows(spark, sf, texts, odd, none):
    tokenizer = Tokenizer.from_file(WORD)
    for r in queries.QUERIES["op7_bpe"](spark, sf).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(tokenizer, texts[r["doc_id"]])
    for path in (WORD, BYTE):
        tokenizer = Tokenizer.from_file(path)
        want = sorted((r["doc_id"] or 0, *digests(tokenizer, r["text"] or "")) for r in odd.collect())
        got = code_texts(odd, path, outputs=True)
        assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()) == want
    assert code_texts(none, WORD).count() == 0


def check_packing(rows, want, capacity):
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, ids in want:
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])[:-(-len(ids) // capacity)]
        for n, r in enumerate(pieces):
            part = np.array(ids[n * capacity:(n + 1) * capacity], "<u4")
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (n, n * capacity, len(part), zlib.crc32(part.tobytes()))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_query(spark, sf, texts):
    rows = queries.QUERIES["op4_packing"](spark, sf).collect()
    used = check_packing(rows, [(i, [*whole(WORD)(t), 0]) for i, t in texts.items()], 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_in_shards_and_odd_rows(spark, odd, none):
    rows = pack_documents(odd, WORD, 0, capacity=16, shard=300).collect()
    assert len([r for r in rows if r["doc_id"] == 3]) == 2
    want = [(r["doc_id"], [*whole(WORD)(r["text"] or ""), 0]) for r in odd.collect() if r["doc_id"] != 3]
    check_packing(rows, want, 16)
    assert sum(r["length"] for r in rows) == sum(len(whole(WORD)(r["text"] or "")) + 1 for r in odd.collect())
    assert pack_documents(none, WORD, 0).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_place_makes_the_sum_of_squares_smallest(lengths):
    """Every choice against all open gaps tried one by one."""
    capacity, gaps = 50, []
    sequence, offset = place(np.array(lengths, np.int64), capacity)
    for size, which, at in zip(lengths, sequence.tolist(), offset.tolist(), strict=True):
        def squares(gaps):
            return sum(n * n for gap, n in zip(*np.unique([g for g in gaps if 0 < g < capacity], return_counts=True), strict=True))
        fit = [n for n, gap in enumerate(gaps) if gap >= size]
        if fit and size < capacity:
            costs = {n: squares([*gaps[:n], gaps[n] - size, *gaps[n + 1:]]) for n in fit}
            assert which in costs and costs[which] == min(costs.values())
        else:
            assert which == len(gaps)
            gaps.append(capacity)
        assert at == capacity - gaps[which]
        gaps[which] -= size
