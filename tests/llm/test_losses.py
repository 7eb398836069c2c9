"""Trials that once lost links or bounds: extreme doubles, ids with several texts, many equal pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm.metric_join import near_vectors
from faultline.llm.minhash import near_duplicates
from faultline.llm.packing import PIECES, pack


@pytest.mark.parametrize("block_rows", [16, 4096])
@pytest.mark.parametrize("extreme", [1e-200, 1e200, 5e-324])
def test_extreme_doubles_link_as_their_directions(spark, extreme, block_rows):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(10, 8))
    rows = np.concatenate([base[n % 10] + 0.05 * rng.normal(size=8) for n in range(80)]).reshape(80, 8).tolist()
    rows += [[extreme] * 8, [extreme] * 7 + [0.0], [1.0] * 8]
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame, block_rows=block_rows).collect()}
    x = np.array(rows)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.minimum(label, np.where(near, label, len(x)).min(axis=1))
    assert got == {n: (int(near[n].sum()), int(label[n])) for n in range(len(x))}


def test_every_pair_of_blocks_meets_once_at_scale(spark):
    """All vectors of scale 0.1 in small blocks, against one product."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(rows, block_rows=128).collect()}
    held = rows.collect()
    x = np.array([r["embedding"] for r in held], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    counts = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert got == {r["vec_id"]: int(c) for r, c in zip(held, counts)}


def words(seed, change=()):
    rng = np.random.default_rng(seed)
    out = [f"w{n}" for n in rng.integers(0, 10_000, 120)]
    for at in change:
        out[at] = "other"
    return " ".join(out)


def test_an_id_with_several_texts_keeps_all_links(spark):
    rows = [(1, words(1)), (1, words(2)), (2, words(1, [5])), (3, words(2, [7])), (4, words(3)), (5, words(3, [9])), (6, words(4)),
            (None, words(4)), (7, None), (7, ""), (8, words(2)), (8, words(5)), (9, words(5))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("clash") for c in ("row", "id", "part", "whole", "least")})
    got = {}
    for r in near_duplicates(frame, size=2).collect():
        got.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert got == {1: {(1, True)}, 2: {(1, False)}, 3: {(1, False)}, 8: {(1, False)}, 9: {(1, False)}, 4: {(4, True)},
                   5: {(4, False)}, 6: {(6, True)}, 7: {(7, True)}, None: {(None, True)}}


def test_equal_pieces_do_not_share_a_shard(spark, tmp_path):
    rows = [(5, 0, 0, 300, 9)] * 20_000 + [(n, 0, 0, n % 2048 + 1, n) for n in range(40_000)]
    spark.createDataFrame(rows, PIECES).repartition(4).write.parquet(f"{tmp_path}/pieces")
    placed = pack(spark.read.parquet(f"{tmp_path}/pieces")).toPandas()
    shards = placed.groupby(placed["sequence_id"] // 2 ** 32).size()
    assert len(placed) == 60_000 and shards.max() < 2 * 8192
    filled = placed.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 2048
