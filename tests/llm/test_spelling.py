"""Spelling variants against plain comparison, the bound against all edits, and odd texts."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from faultline.llm.queries import QUERIES
from faultline.llm.spelling import (CLOSE, OPEN, Grams, gram_dictionary, near_words, roots, spelling_variants, word_counts)

LETTERS = "abéxn"


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 199 == 0:
                run = run[:mark % len(run)] + run[mark % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def holes(word):
    return {word[:i] + word[i + 1:] for i in range(len(word))}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return a in holes(b) if len(b) == len(a) + 1 else b in holes(a) if len(a) == len(b) + 1 else False


def plain_variants(counts):
    """All pairs, shared holes as a first look."""
    by_hole = {}
    for w in counts:
        for h in holes(w) | {w}:
            by_hole.setdefault(h, []).append(w)
    near = {w: set() for w in counts}
    for words in by_hole.values():
        for a in words:
            near[a].update(b for b in words if b != a and one_edit(a, b))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def rows_of(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_against_plain_comparison(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = plain_variants(plain_words(docs))
    assert rows_of(QUERIES["op12_spelling"](spark, sf)) == want and any(v[0] for v in want.values())


def edits(word):
    for i in range(len(word) + 1):
        for c in LETTERS:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]
        if i < len(word):
            yield word[:i] + word[i + 1:]


@pytest.mark.parametrize("seed", range(6))
def test_bound_holds_for_every_edit(seed):
    rng = random.Random(seed)
    alphabet = LETTERS + OPEN + CLOSE
    dictionary = set()
    for _ in range(rng.choice([3, 30, 120])):  # with every gram, its beginnings from three characters on
        gram = "".join(rng.choices(alphabet, k=4))
        dictionary |= {gram[:3], gram} if rng.random() < 0.7 else {gram[:3]}
    index = Grams(dictionary, 4)
    for _ in range(30):
        word = "".join(rng.choices(LETTERS, k=rng.randint(6, 12)))
        grams = index.split(word)
        most = index.touched(grams, word)
        assert most < len(grams)
        mine = Counter(g for _, g in grams)
        for other in edits(word):
            shared = sum((mine & Counter(g for _, g in index.split(other))).values())
            assert shared >= len(grams) - most


def test_near_words_against_plain_comparison(spark):
    rng = random.Random(1)
    words = {"".join(rng.choices("ab", k=rng.randint(6, 9))) for _ in range(300)} | {"straße", "strasse", "éàüöîñ", "éàüöîn"}
    frame = spark.createDataFrame([(w, 5) for w in sorted(words)], "word string, n bigint")
    want = {(a, b) for a in words for b in words if a != b and one_edit(a, b)}
    for parents in (2, 40, 100_000):
        got = [(r["a"], r["b"]) for r in near_words(frame, parents=parents).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert gram_dictionary(frame, 4, 40) and not gram_dictionary(frame.filter("false"), 4, 40)
    with pytest.raises(ValueError):
        near_words(frame, longest=5)


def test_chains_and_ties(spark):
    counts = {"abcdefgh": 5, "abcdefg": 25, "abcdef": 125, "xbcdef": 125, "abcdeff": 24, "zzzzzz": 7}
    frame = spark.createDataFrame(sorted(counts.items()), "word string, n bigint")
    got = rows_of(spelling_variants(frame))
    assert got == plain_variants(counts)
    assert got["abcdefgh"][:2] == ("abcdefg", "abcdef") and got["abcdeff"][:2] == ("abcdef", "abcdef")
    chain = [(f"w{n:02}", f"w{n + 1:02}") for n in range(27)]
    last = roots(spark.createDataFrame(chain, "word string, form string"))
    assert {r["root"] for r in last.collect()} == {"w27"} and last.count() == 27


def test_odd_texts(spark, odd, none):
    got = {r["word"]: r["n"] for r in word_counts(odd, least_count=1).collect()}
    rows = odd.select("doc_id", "text").collect()
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run if mark % 199 else run[:mark % len(run)] + run[mark % len(run) + 1:]] += 1
    assert got == {w: n for w, n in found.items() if len(w) >= 6}
    clashing = odd.withColumns({c: F.lit("clash") for c in ("word", "run", "n_near", "form", "root", "gram")})
    assert spelling_variants(word_counts(clashing, least_count=1)).count() == len(got)
    assert spelling_variants(word_counts(none)).count() == 0
