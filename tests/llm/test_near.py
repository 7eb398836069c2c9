"""Near copies of vectors and documents against brute force, components, and the pipeline."""

import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from faultline.llm import minhash, queries
from faultline.llm.components import components
from faultline.llm.metric_join import near_vectors
from faultline.llm.minhash import near_duplicates
from faultline.llm.toxicity import learn, score


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 900, (700, 2))] + [(n, n + 1) for n in range(1000, 1100)]
    edges += [(5000, n) for n in range(5001, 5300)] + [(7, 7)]
    sets = Sets()
    for a, b in edges:
        sets.join(a, b)
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: sets.find(n) for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_vectors(rows, least):
    ids = [i for i, v in rows]
    good = [n for n, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, sets = Counter(), Sets()
    for n, a in enumerate(good):
        for b in good[n + 1:]:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[a] += 1
                links[b] += 1
                sets.join(ids[a], ids[b])
    return {i: (links[n], sets.find(i), sets.find(i) == i) for n, i in enumerate(ids)}


@pytest.mark.parametrize("block,pivots", [(4096, 1024), (8, 1024), (8, 3)])
def test_metric_join_of_odd_vectors(spark, block, pivots):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(n, (centres[n % 6] + rng.normal(size=8) * (0.05 if n % 3 else 0.6)).tolist()) for n in range(90)]
    rows += [(100 + n, rows[0][1]) for n in range(5)] + [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0, None] * 4),
             (204, [float("nan")] * 8), (205, [float("inf")] + [1.0] * 7), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (208, [-0.0, 1.0]), (209, [0.0, 1.0])]
    frame = spark.createDataFrame([(i, v, i % 4, "x") for i, v in rows],
                                  "vec_id bigint, embedding array<double>, label int, cell string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           near_vectors(frame, block_rows=block, most_pivots=pivots).collect()}
    assert got == brute_vectors(rows, 0.9)
    assert near_vectors(frame.filter("false")).count() == 0


def test_metric_join_query(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.QUERIES["op3_metric_join"](spark, sf).collect()}
    assert got == brute_vectors(rows, 0.9)


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[n:n + size]) for n in range(len(words) - size + 1))


def brute_documents(rows, size):
    sets, found = Sets(), {i: shingles(t, size) for i, t in rows}
    posted = defaultdict(list)
    for i, s in found.items():
        for shingle in s:
            posted[shingle].append(i)
    tested = set()
    for ids in posted.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                if (a, b) not in tested:
                    tested.add((a, b))
                    both = len(found[a] & found[b])
                    if 100 * both >= 80 * (len(found[a]) + len(found[b]) - both):
                        sets.join(a, b)
    return {i: (len(s), sets.find(i), sets.find(i) == i) for i, s in found.items()}


def as_dict(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect()}


def test_minhash_query(spark, sf, texts):
    assert as_dict(queries.QUERIES["op6_minhash"](spark, sf)) == brute_documents(list(texts.items()), 2)


def mutated(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.integers(1 << 30)}" for w in words)


@pytest.mark.parametrize("tile", [1 << 20, 2000])
def test_minhash_of_a_large_group_of_near_copies(spark, tile, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", tile)
    rng = np.random.default_rng(2)
    base = [f"w{n}" for n in range(120)]
    rows = [(n, mutated(rng, base, rng.choice([0.0, 0.03, 0.06, 0.12]))) for n in range(150)]
    rows += [(1000 + n, "a common opening line of all texts " + " ".join(f"x{n}y{k}" for k in range(rng.integers(1, 40)))) for n in range(100)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_dict(near_duplicates(frame, size=2)) == brute_documents(rows, 2)


def test_minhash_of_odd_rows(spark, odd, none):
    got = {}
    for r in near_duplicates(odd, size=5).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[1] == {(0, 1, True)} and got[2] == {(0, 2, True)} and got[9] == {(0, 9, True)} and got[3] == {(1, 3, True)}
    assert got[7] == {(9, 7, True)} and got[8] == {(9, 7, False)} and len(got[None]) == 1
    assert near_duplicates(none).count() == 0


def test_pipeline_against_brute_force(spark, sf, documents, texts):
    docs = documents
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, sf)
    rejected = {r["doc_id"] for r in score(docs, learn(docs, labels)).filter("predicted = 1").collect()}
    kept = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(kept) == set(texts) - rejected and clean.columns == docs.columns
    single = stage["minhash"](spark, clean, sf)
    want = {i for i, (_, _, first) in brute_documents(list(kept.items()), 5).items() if first}
    assert {r["doc_id"] for r in single.collect()} == want and single.columns == docs.columns
    masked = {r["doc_id"]: r for r in stage["secrets"](spark, single, sf).collect()}
    assert set(masked) == want
    for doc_id, r in masked.items():
        text = kept[doc_id]
        assert (r["text"] == text) or "[SECRET]" in r["text"]
        assert not re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r["text"]) and r["n_chars"] == len(r["text"])
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in packed} == want


def test_pipeline_stages_on_odd_rows(spark, sf, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, sf)
        if name != "packing":
            assert got.columns == odd.columns and got.schema == odd.schema
        ids = sorted(r["doc_id"] or 0 for r in got.select("doc_id").collect())
        if name == "minhash":
            assert ids == [0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 12]
        elif name != "packing":
            assert ids == sorted(r["doc_id"] or 0 for r in odd.collect())
        assert stage(spark, none, sf).count() == 0
