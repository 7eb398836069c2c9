from unittest import mock

import numpy as np
import pytest
from faultline.operators import cells, topk
from faultline.operators.vector_search import ResidentIndex, check_vector_column, constant_search, vector_search
from faultline.schemas import MANUAL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = ["COSINE", "IP", "L2"]


def naive(probes, corpus, metric, k):
    """{probe: [(id, score)]} by comparing every pair."""
    found = {}
    for key, p in probes.items():
        if p is None or (metric == "COSINE" and not any(p)):
            continue
        scored = []
        for id_, c in corpus.items():
            if c is None or (metric == "COSINE" and not any(c)):
                continue
            a, b = np.asarray(p, np.float32).astype(float), np.asarray(c, np.float32).astype(float)
            dot = (a * b).sum()
            score = {"IP": dot, "L2": np.sqrt(((a - b) ** 2).sum()),
                     "COSINE": dot / max(np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()), 1e-300)}[metric]
            scored.append((score if metric == "L2" else -score, id_, score))
        if scored:
            found[key] = [(i, s) for _, i, s in sorted(scored)[:k]]
    return found


def frame(spark, vectors, key, name, parts=3):
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField(name, T.ArrayType(T.FloatType()))])
    rows = [(k, None if v is None else [float(x) for x in v]) for k, v in vectors.items()]
    return spark.createDataFrame(rows, schema).repartition(parts)


def collected(df, key):
    found = {}
    for r in df.orderBy(key, "rank").collect():
        if r.id is not None:
            found.setdefault(r[key], []).append((r.id, r.score))
    return found


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert [i for i, _ in a[key]] == [i for i, _ in b[key]], key
        assert np.allclose([s for _, s in a[key]], [s for _, s in b[key]], rtol=0, atol=1e-9)


def sample(seed, probes=60, corpus=150, width=6):
    """Vectors with a third of the corpus copies of one vector, zero vectors and NULLs."""
    rng = np.random.default_rng(seed)
    c = {i: list(rng.integers(-3, 4, width).astype(float)) for i in range(corpus)}
    for i in range(0, corpus, 3):
        c[i] = [1.0, 2.0, 0.0, 1.0, 0.0, 0.0]
    c[7], c[8] = [0.0] * width, None
    p = {1000 + i: list(rng.integers(-3, 4, width).astype(float)) for i in range(probes)}
    for i in range(0, probes, 3):
        p[1000 + i] = [1.0, 2.0, 0.0, 1.0, 0.0, 0.0]
    p[1001], p[1002] = None, [0.0] * width
    return p, c


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("strategy", ["resident", "blocked", "cells", "codes"])
def test_strategies_equal_brute_force(spark, metric, strategy):
    p, c = sample(1)
    found = vector_search(frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec"), "v", "vec", k=4, metric=metric,
                          key="pid", strategy=strategy, smallest_tile=16, tile_bytes=16 * 24, cells=4, nprobe=4)
    same(collected(found, "pid"), naive(p, c, metric, 4))


@pytest.mark.parametrize("strategy", ["resident", "blocked"])
def test_distinct_probes_give_the_same_rows(spark, strategy):
    p, c = sample(2)
    probes = frame(spark, p, "pid", "v").withColumn("kind", F.when(F.col("v").isNotNull(), F.hash("v")))
    options = dict(k=3, key="pid", how="left", strategy=strategy)
    one = vector_search(probes, frame(spark, c, "id", "vec"), "v", "vec", distinct_by="kind", **options)
    assert one.where("pid in (1001, 1002) and id is null and score is null").count() == 2
    same(collected(one, "pid"), naive(p, c, "COSINE", 3))


@pytest.mark.parametrize("strategy", ["resident", "blocked", "codes"])
def test_partitioning_does_not_matter(spark, strategy):
    p, c = sample(3)
    results = []
    for parts in (1, 5):
        found = vector_search(frame(spark, p, "pid", "v", parts), frame(spark, c, "id", "vec", parts), "v", "vec",
                              k=5, key="pid", strategy=strategy, smallest_tile=8 * parts, tile_bytes=192 * parts)
        results.append(sorted(map(tuple, found.select("pid", "id", "rank", "score").collect())))
    assert results[0] == results[1]


def test_left_keeps_rows_without_hits_and_inner_drops_them(spark):
    p, c = {1: [1.0, 0.0], 2: None, 3: [0.0, 0.0]}, {5: [1.0, 1.0]}
    args = frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec"), "v", "vec"
    for strategy in ("resident", "blocked"):
        assert {r.pid for r in vector_search(*args, key="pid", strategy=strategy).collect()} == {1}
        left = vector_search(*args, key="pid", how="left", strategy=strategy).collect()
        assert {(r.pid, r.id) for r in left} == {(1, 5), (2, None), (3, None)}


def test_empty_corpus_after_filter(spark):
    p, c = sample(4)
    for strategy in ("resident", "blocked"):
        args = dict(k=2, key="pid", where="id < 0", strategy=strategy)
        found = vector_search(frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec"), "v", "vec", **args)
        assert found.count() == 0
        left = vector_search(frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec"), "v", "vec", how="left", **args)
        assert left.count() == len(p)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 7), st.sampled_from(METRICS), st.integers(1, 90), st.integers(1, 9),
       st.sampled_from([1, 3, 64]))
def test_kernel_equals_brute_force(seed, k, metric, corpus, width, group):
    with mock.patch.object(topk, "GROUP", group):
        compare_with_brute_force(seed, k, metric, corpus, width)


def compare_with_brute_force(seed, k, metric, corpus, width):
    rng = np.random.default_rng(seed)
    c = rng.integers(-2, 3, (corpus, width)).astype(np.float32)
    p = rng.integers(-2, 3, (9, width)).astype(np.float32)
    ids = rng.permutation(corpus) + 100
    tile = topk.pack(ids, c, metric, k)
    for search in (topk.search, topk.search_distinct):
        row, pos, score, rank = search(tile, p, metric, k)
        found = {}
        for r, q, s, n in zip(row, pos, score, rank):
            found.setdefault(int(r), []).append((int(tile["ids"][q]), float(s)))
            assert n == len(found[int(r)]) <= k
        same(found, naive(dict(enumerate(p.tolist())), dict(zip(ids.tolist(), c.tolist())), metric, k))


def test_kernel_in_small_steps(monkeypatch):
    rng = np.random.default_rng(5)
    c, p = rng.normal(size=(300, 16)).astype(np.float32), rng.normal(size=(70, 16)).astype(np.float32)
    tile = topk.pack(np.arange(300), c, "COSINE", 4)
    whole = topk.search(tile, p, "COSINE", 4)
    monkeypatch.setattr(topk, "CELLS_AT_ONCE", 900)
    for a, b in zip(whole, topk.search(tile, p, "COSINE", 4)):
        assert np.array_equal(a, b)


def test_constant_probe(spark):
    _, c = sample(6)
    probe = [0.01] * 6
    found = constant_search(frame(spark, c, "id", "vec"), probe, "vec", 3, "IP")
    assert [(r.id, round(r.score, 6)) for r in found.orderBy(F.desc("score"), "id").collect()] == [
        (i, round(s, 6)) for i, s in naive({0: probe}, c, "IP", 3)[0]]


def test_contract_of_columns(spark):
    p, c = sample(7)
    probes, corpus = frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec")
    found = vector_search(probes, corpus, "v", "vec", key="pid")
    assert found.columns == ["pid", "v", "id", "vec", "rank", "score"]
    assert found.schema["score"].dataType == T.DoubleType()
    with pytest.raises(ValueError, match="both sides"):
        vector_search(probes.withColumn("id", F.lit(1)), corpus, "v", "vec", key="pid")
    prefixed = vector_search(probes.withColumn("id", F.lit(1)), corpus, "v", "vec", key="pid", prefix="m_")
    assert prefixed.columns == ["pid", "v", "id", "m_id", "m_vec", "rank", "score"]


def test_refusals(spark):
    p, c = sample(8)
    probes, corpus = frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec")
    with pytest.raises(ValueError, match="COSINE, L2, IP"):
        vector_search(probes, corpus, "v", "vec", key="pid", metric="DOT")
    with pytest.raises(ValueError, match="top-level"):
        check_vector_column(corpus, "a.vec")
    with pytest.raises(ValueError, match="not an array"):
        check_vector_column(corpus, "id")
    with pytest.raises(ValueError, match="bound"):
        ResidentIndex(corpus, "vec", "id", "COSINE", 1, max_bytes=10)
    narrow = frame(spark, {1: [1.0, 2.0]}, "pid", "v")
    with pytest.raises(Exception, match="width"):
        vector_search(narrow, corpus, "v", "vec", key="pid").collect()


def test_text_keys(spark):
    p, c = sample(9)
    corpus = frame(spark, c, "id", "vec").withColumn("id", F.format_string("s%03d", "id"))
    for strategy in ("resident", "blocked"):
        found = vector_search(frame(spark, p, "pid", "v"), corpus, "v", "vec", k=2, key="pid", strategy=strategy)
        expected = {k: [(f"s{i:03d}", s) for i, s in v] for k, v in naive(p, c, "COSINE", 2).items()}
        same(collected(found, "pid"), expected)


def test_recall_grows_with_visited_cells(spark, sf):
    from __spark_entry__ import queries
    shares = [r.recall for r in queries()["vs_ann_recall"](spark, sf).orderBy("visited").collect()]
    assert shares == sorted(shares) and shares[-1] == 1.0


def test_manual_schema_is_searchable():
    assert MANUAL["vec"].dataType == T.ArrayType(T.FloatType())
    assert cells._geometry("IP") == ("euclidean", "L2")


@pytest.mark.parametrize("metric", METRICS)
def test_kernel_on_many_distinct_vectors_and_broken_ones(metric):
    rng = np.random.default_rng(11)
    c, p = rng.normal(size=(2000, 12)).astype(np.float32), rng.normal(size=(30, 12)).astype(np.float32)
    c[5, 3], c[77, 0], p[4, 2] = np.nan, np.inf, np.nan
    row, pos, score, _ = topk.search(tile := topk.pack(np.arange(2000), c, metric, 6), p, metric, 6)
    sane = {i: v.tolist() for i, v in enumerate(c) if np.isfinite(v).all()}
    want = naive({i: v.tolist() for i, v in enumerate(p) if i != 4}, sane, metric, 6)
    found = {}
    for r, q, s in zip(row, pos, score):
        found.setdefault(int(r), []).append((int(tile["ids"][q]), float(s)))
    same(found, want)


@pytest.mark.parametrize("k", [1, 2])
def test_repeated_keys_have_their_own_hits_under_every_strategy(spark, k):
    rows = [("A", [1.0, 0.0]), ("A", [0.0, 1.0]), ("A", [1.0, 0.0]), ("B", None), ("C", [0.6, 0.8])]
    probes = spark.createDataFrame(rows, "alarm_id STRING, p ARRAY<FLOAT>")
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.7, 0.7])], "id BIGINT, v ARRAY<FLOAT>")
    got = [sorted((r.alarm_id, str(r.p), r.id or 0, r["rank"] or 0, round(r.score or 0, 6)) for r in vector_search(
        probes, corpus, "p", "v", k=k, how="left", strategy=s, cells=2, nprobe=2).collect()) for s in ("resident", "blocked", "cells", "codes")]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 4 * k + 1


def test_visited_cells_of_a_fitted_index_follow_from_its_measured_recall(spark, sf):
    from faultline.sources import tables
    rows = tables.manual(spark, sf).select("id", F.col("vec").alias("cv"))
    asked = tables.probes(spark, sf).select(F.col("probe_id").alias("key"), F.col("alarm_vector").alias("pv"))
    placed, centroids = cells.build_cells(rows, "cv", 8)
    nprobe, reached = cells.enough_cells(asked, placed, centroids, "COSINE", 3, 8)
    corpus = {r.id: r.cv for r in rows.collect()}
    want = naive({r.key: r.pv for r in asked.collect()}, corpus, "COSINE", 3)

    def share(visited):
        got = collected(vector_search(asked, rows, "pv", "cv", k=3, key="key", strategy="cells", cells=8,
                                      nprobe=visited, built=(placed, centroids)), "key")
        return sum(len({i for i, _ in want[k]} & {i for i, _ in got.get(k, [])}) for k in want) / sum(map(len, want.values()))

    assert 1 < nprobe < 8 and reached >= 0.9 > share(nprobe - 1)
    assert share(nprobe) == pytest.approx(reached)


def test_copies_do_not_leave_the_resident_search(spark):
    """The size that counts is that of the distinct vectors; a corpus of copies is not cut into tiles."""
    p, c = sample(10)
    c |= {1000 + i: v for i, v in c.items()} | {2000 + i: v for i, v in c.items()}
    probes, corpus = frame(spark, p, "pid", "v"), frame(spark, c, "id", "vec")
    tiled, bound = "faultline.operators.vector_search.tiled_hits", "faultline.operators.vector_search.RESIDENT_BYTES"
    for metric in METRICS:
        with mock.patch(bound, 40 * 300), mock.patch(tiled, side_effect=AssertionError("cut into tiles")):
            same(collected(vector_search(probes, corpus, "v", "vec", k=2, key="pid", metric=metric), "pid"),
                 naive(p, c, metric, 2))
        with mock.patch(bound, 40 * 30):  # too many distinct ones: tiles of those
            same(collected(vector_search(probes, corpus, "v", "vec", k=2, key="pid", metric=metric), "pid"),
                 naive(p, c, metric, 2))


@pytest.mark.parametrize("strategy", ["resident", "blocked"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_only_rows_hit_are_asked_for(spark, strategy, how):
    """With rows_of the corpus rows come by the ids that were hit; repeated ids and keys, NULLs and a filter stay."""
    p, c = sample(11)
    probes = frame(spark, p, "pid", "v").withColumn("pid", F.col("pid") - F.col("pid") % 2)
    corpus = frame(spark, c, "id", "vec").withColumn("id", F.when(F.col("id") % 9 != 0, F.col("id") - F.col("id") % 3))
    corpus = corpus.withColumn("even", F.size("vec") % 2 == 0).withColumn("text", F.col("vec").cast("string"))
    asked = []

    def rows_of(ids):
        asked.append({r.id for r in ids.collect()})
        return corpus.join(ids, "id", "left_semi")

    def search(**options):
        found = vector_search(probes, corpus, "v", "vec", k=2, key="pid", strategy=strategy, how=how,
                              where="even", payload=["id", "text"], **options)
        return sorted(map(str, found.collect()))

    plain, by_id = search(), search(rows_of=rows_of)
    assert by_id == plain and plain
    assert asked == [{r.id for r in corpus.collect() if any(f"id={r.id}," in row for row in plain)} - {None}]


def test_texts_without_a_hit_are_dropped_where_they_are_read(spark, sf):
    from faultline.plans import retrieve
    from faultline.sources import tables
    given = []
    with mock.patch.object(tables, "manual", side_effect=lambda *a, f=tables.manual, **k: given.append(k) or f(*a, **k)):
        context = retrieve.context(spark, sf)
    named = [k["only"] for k in given if "only" in k]
    hit = {int(r.doc_ref[3:]) for r in context.select("doc_ref").distinct().collect()}
    assert len(named) == 1 and {r.id for r in named[0].collect()} >= hit and hit
    plan = context._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, (doc_id" in plan
