"""Rule statistics by hand, the forest's depths, held-out labels, and odd texts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.llm.quality import (COUNTS, base_failed, calibrate, expected_depth, grow, quality_report, scored, statistics,
                                   text_counts, tree_nodes)
from faultline.llm.queries import QUERIES


def by_hand(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, held = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            held |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(held)}


def test_query_by_hand(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op13_quality"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = by_hand(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (r["kept"] and r["base_failed"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b\x1f #é", max_size=60), min_size=1, max_size=6))
def test_statistics_of_any_text(texts):
    got = text_counts(pa.array(texts))
    for n, text in enumerate(texts):
        assert {k: int(v[n]) for k, v in got.items() if k in by_hand("")} == by_hand(text)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    learnt, rest = (labels.filter((F.crc32(F.col("doc_id").cast("string")) % 2 == n)) for n in (0, 1))
    got = quality_report(docs, learnt).join(rest, "doc_id").filter("NOT base_failed").groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in got}
    assert kept[1] > 0.98 and kept[0] < 0.05


def test_depths_of_a_tree():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.random((63, 2)), [[9.0, 9.0]]])
    totals = np.zeros(64)
    for seed in range(50):
        nodes = tree_nodes(x, np.random.default_rng(seed), 6)
        for row, v in enumerate(x):
            at, steps = 0, 0
            while nodes[at][1] >= 0:
                at, steps = (nodes[at][3] if v[nodes[at][1]] < nodes[at][2] else nodes[at][4]), steps + 1
            assert steps <= 6 and nodes[at][5] >= steps
            totals[row] += nodes[at][5]
    assert totals.argmin() == 63
    assert expected_depth(1) == 0 and expected_depth(2) == 1 and np.isclose(expected_depth(3), 2 * 1.5 - 4 / 3)


def test_forest_finds_what_stands_apart(spark):
    letters = "abcdefghij"
    rows = [(n, " ".join("wo" + letters[k % 10] + letters[(k * n) % 10] + letters[k // 10] for k in range(90))) for n in range(400)]
    rows += [(1000 + n, t.replace(" ", "### ")) for n, t in rows[:12]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, int(n < 1000)) for n, _ in rows[::2]], "doc_id bigint, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality_report(docs, labels).collect()}
    assert all(got[n] == (n < 1000) for n in got)
    counted = statistics(docs)
    forest = grow(counted.filter(~base_failed()))
    assert len(forest.roots) == 200 and len(forest.measure) <= 200 * 2 * 64
    again = grow(counted.repartition(5).filter(~base_failed()))
    assert np.array_equal(forest.cut, again.cut)
    judged = scored(counted, forest)
    assert calibrate(judged, labels.filter("quality = 1")) == float("inf")
    assert calibrate(judged, labels.filter("false")) == float("inf")


def test_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (4, 1)], "doc_id bigint, quality int")
    clashing = odd.withColumns({c: F.lit("clash") for c in [*COUNTS, "x", "chance", "tree", "base_failed", "quality", "count"]})
    got = quality_report(clashing, labels).collect()
    assert len(got) == odd.count()
    want = Counter(tuple(sorted(by_hand(r["text"]).items())) for r in odd.select("text").collect())
    assert Counter(tuple(sorted((k, r[k]) for k in by_hand(""))) for r in got) == want
    assert quality_report(none, labels).count() == 0 and quality_report(odd.filter("doc_id = 1"), labels).count() == 1


@pytest.mark.parametrize("times", [1, 60])
def test_one_text_many_times(spark, times):
    text = " ".join(f"word{n}" for n in range(80))
    docs = spark.createDataFrame([(5, text)] * times, "doc_id bigint, text string")
    labels = spark.createDataFrame([(5, 1)], "doc_id bigint, quality int")
    assert [r["kept"] for r in quality_report(docs, labels).collect()] == [True] * times
