"""The index of quantised codes: bounds that hold, exact hits, and how few vectors are looked at."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from faultline.operators import codes
from faultline.operators.vector_search import best, tiled_hits, vector_search
from faultline.schemas import METRICS
from faultline.sources import tables

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("metric", METRICS)
def test_scores_lie_within_their_bounds(metric):
    rng = np.random.default_rng(2)
    x = codes.placed_vectors(rng.normal(size=(300, 7)) * 10.0 ** rng.integers(-2, 3, (300, 1)), metric)
    p = codes.placed_vectors(rng.normal(size=(40, 7)) * 3, metric)
    centres = codes.k_means(x, 5, 5, rng)
    cell = codes.nearest(x, centres)
    words = np.stack([rng.normal(size=(256, 2)) for _ in range(4)])  # words that fit badly
    seen = codes.decoded(codes.encoded(x, cell, centres, words), cell, centres, words)
    miss = np.sqrt(((x - seen) ** 2).sum(axis=1))
    off = np.abs(codes.goodness(p, seen, metric) - codes.goodness(p, x, metric))
    assert (off <= codes.reach(p, seen, miss, metric)).all()


def test_exact_and_mostly_unseen(spark):
    """All hits of brute force at scale 0.1, with far fewer than half of the vectors read."""
    rows = tables.manual(spark, SF).select("id", F.col("vec").alias("cv"))
    asked = tables.probes(spark, SF).select(F.col("probe_id").alias("key"), F.col("alarm_vector").alias("pv"))
    index = codes.build_codes(rows, 16)
    hits, looked_at = codes.code_hits(asked, index, 3)
    exact = best(tiled_hits(asked, rows, "COSINE", 3), "COSINE", 3)
    columns = ["key", "id", "rank", "score"]
    assert sorted(map(tuple, hits.select(columns).collect())) == sorted(map(tuple, exact.select(columns).collect()))
    pairs = asked.count() * index.entries.count()
    share = looked_at.count() / pairs  # 0.057 when this was written
    assert share < 0.1
    assert index.entries.agg(F.max(F.length("code"))).first()[0] == 32  # of 256 bytes


def test_copies_are_one_entry(spark):
    """A third of the corpus is one vector: one entry, whose smallest ids are hits."""
    rng = np.random.default_rng(4)
    rows = [(n, [1.0, 2.0, 3.0] if n % 3 == 0 else rng.normal(size=3).tolist()) for n in range(3000)]
    corpus = spark.createDataFrame(rows, "id BIGINT, cv ARRAY<FLOAT>").repartition(6)
    index = codes.build_codes(corpus, 4, most_k=5)
    assert index.entries.count() == 2001 and index.entries.agg(F.max(F.size("ids"))).first()[0] == 5
    asked = spark.createDataFrame([("p", [1.0, 2.0, 3.0])], "key STRING, pv ARRAY<FLOAT>")
    hits, _ = codes.code_hits(asked, index, 5)
    assert [r.id for r in hits.orderBy("rank").collect()] == [0, 3, 6, 9, 12]
    with pytest.raises(ValueError):
        codes.code_hits(asked, index, 6)
    with pytest.raises(PythonException):
        codes.code_hits(spark.createDataFrame([("p", [1.0, 2.0])], "key STRING, pv ARRAY<FLOAT>"), index, 2)[0].collect()


def test_rows_unlike_the_sample_are_found(spark):
    """The fit sees a few rows only; hits do not depend on it."""
    rng = np.random.default_rng(6)
    rows = [(n, (rng.normal(size=4) + (40 if n > 90 else 0)).tolist()) for n in range(100)]
    corpus = spark.createDataFrame(rows, "id BIGINT, cv ARRAY<FLOAT>")
    asked = spark.createDataFrame([(n, v) for n, v in rows], "key BIGINT, pv ARRAY<FLOAT>")
    for metric in METRICS:
        hits, _ = codes.code_hits(asked, codes.build_codes(corpus, 3, metric, sample=8), 4)
        exact = best(tiled_hits(asked, corpus, metric, 4), metric, 4)
        columns = ["key", "id", "rank", "score"]
        assert sorted(map(tuple, hits.select(columns).collect())) == sorted(map(tuple, exact.select(columns).collect()))


def test_empty_corpus_and_wrong_metric(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0])], "id BIGINT, vec ARRAY<FLOAT>")
    probes = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "alarm_id STRING, p ARRAY<FLOAT>")
    none = vector_search(probes, corpus.filter("false"), "p", "vec", how="left", strategy="codes")
    assert [(r.alarm_id, r.id) for r in none.orderBy("alarm_id").collect()] == [("a", None), ("b", None)]
    with pytest.raises(ValueError):
        vector_search(probes, corpus, "p", "vec", strategy="codes", metric="L2",
                      built=codes.build_codes(corpus.withColumnRenamed("vec", "cv")))


def test_pairs_to_be_read_are_not_stored(spark):
    """Their number grows with the product of both sides: only entries, codes and floors are stored."""
    import glob

    from faultline.session import shared_dir
    rng = np.random.default_rng(8)
    rows = [(n, rng.normal(size=6).tolist()) for n in range(200)]
    corpus = spark.createDataFrame(rows, "id BIGINT, cv ARRAY<FLOAT>")
    asked = spark.createDataFrame(rows, "key BIGINT, pv ARRAY<FLOAT>")
    place = shared_dir(spark).removeprefix("file:") + "/candidates-*"
    before = len(glob.glob(place))
    hits, _ = codes.code_hits(asked, codes.build_codes(corpus, 3), 2)
    assert hits.where("rank = 1 AND key = id").count() == 200 and len(glob.glob(place)) == before
