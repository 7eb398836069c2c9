"""An index of quantised codes whose search is exact: bounds decide which vectors are looked at, never which are lost.

Every distinct corpus vector is coded in ``PAIR`` dimensions at a time as the nearest of ``WORDS`` words, after the centre of its
cell is taken off; beside the code lies the exact length of what the code misses. A probe's score with a coded vector is
then known up to that length (times the probe's, where the score is a product). ``code_hits`` goes

1. to each probe's nearest cell, where the exact scores of its k best by code give the floor that the k-th best hit reaches;
2. to every cell whose centre and radius leave room for a better score, and there to the codes: a vector is read only if
   its upper bound reaches the floor and what the tile's own k best by code reach;
3. in the same task to those vectors, a bounded number at a time: double precision decides, ties go to the smaller id, and
   at most k entries a probe leave the tile.

The codes take an eighth of the vectors (one byte for two single-precision numbers), so a scan of them is short; the vectors lie
beside them in the tile, so that the pairs to be read, whose number grows with the product of both sides, are never
held or moved. Centres and words are fitted on at most ``SAMPLE`` rows, chosen by
a hash; every row is coded, and rows unlike the sample only have longer misses, so the result does not depend on the fit.

Equal vectors are one entry with their ``most_k`` smallest ids (no others can be hits), so a corpus that is one third
copies has no hot entry. Rows without a vector, and under cosine zero vectors, are in no cell.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators import topk
from faultline.operators import vector_search as vs
from faultline.session import materialize

CELLS_AT_ONCE = 4_000_000  # entries of one matrix of bounds held in memory
PAIR, WORDS, SAMPLE = 2, 256, 8192
PAIRS_AT_ONCE = 1 << 16  # pairs of whole vectors held in double precision
SLACK = 1e-9  # of double-precision sums, relative to the lengths involved


@dataclass
class CodeIndex:
    """``entries``: rows ``cell, rep, ids, vec, code, miss``, stored. The book is bounded by its parameters."""

    entries: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    words: np.ndarray
    metric: str
    most_k: int


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """At most k centres of a bounded sample."""
    centres = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        home = nearest(x, centres)
        count = np.bincount(home, minlength=len(centres))
        total = np.stack([np.bincount(home, x[:, d], len(centres)) for d in range(x.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def placed_vectors(vectors: np.ndarray, metric: str) -> np.ndarray:
    """In double precision; under cosine of length one."""
    x = vectors.astype(np.float64)
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True)) if metric == "COSINE" else x


def decoded(code: np.ndarray, cell: np.ndarray, centres: np.ndarray, words: np.ndarray) -> np.ndarray:
    parts = [words[s][code[:, s]] for s in range(len(words))]
    return np.concatenate(parts, axis=1)[:, :centres.shape[1]] + centres[cell]


def encoded(x: np.ndarray, cell: np.ndarray, centres: np.ndarray, words: np.ndarray) -> np.ndarray:
    off = x - centres[cell]
    off = np.pad(off, ((0, 0), (0, len(words) * PAIR - off.shape[1])))
    return np.stack([nearest(off[:, s * PAIR:(s + 1) * PAIR], words[s]) for s in range(len(words))], axis=1).astype(np.uint8)


def distinct_entries(corpus: DataFrame, metric: str, most_k: int) -> DataFrame:
    """``rep, ids, vec`` per distinct usable vector of ``corpus(id, cv)``. Copies are cut to ``most_k`` ids per batch before
    anything is shuffled."""
    kind = corpus.schema["id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("vec", T.ArrayType(T.FloatType()))])

    def fold(batches):
        for batch in batches:
            ids, vectors = vs._ids(pa.chunked_array([batch["id"]])), topk.to_matrix(batch["cv"])
            tile = topk.pack(ids, vectors, metric, most_k)
            if len(tile["vectors"]):
                ends = np.concatenate(([0], np.cumsum(tile["counts"]))).astype(np.int32)
                flat = np.ascontiguousarray(tile["vectors"], np.float32)
                width = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.record_batch([
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(tile["ids"][tile["copies"]], batch["id"].type)),
                    pa.ListArray.from_arrays(pa.array(width), pa.array(flat.ravel() + np.float32(0)))], ["ids", "vec"])

    folded = corpus.where(F.col("cv").isNotNull()).mapInArrow(fold, schema)
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most_k)
    grouped = folded.groupBy("vec").agg(smallest.alias("ids"))
    return grouped.select(F.get("ids", F.lit(0)).alias("rep"), "ids", "vec")


def build_codes(corpus: DataFrame, cells: int = 16, metric: str = "COSINE", most_k: int = 64, sample: int = SAMPLE,
                seed: int = 7) -> CodeIndex:
    """An index of ``corpus(id, cv)``. It answers searches for up to ``most_k`` hits."""
    vs.check_metric(metric)
    found = materialize(distinct_entries(corpus, metric, most_k), "code_entries")
    rows = found.orderBy(F.xxhash64("vec", F.lit(seed))).limit(sample).select("vec").toArrow()
    rng = np.random.default_rng(seed)
    x = placed_vectors(topk.to_matrix(rows["vec"]), metric)
    if not len(x):
        x = np.zeros((1, 1))
    centres = k_means(x, cells, 10, rng)
    off = x - centres[nearest(x, centres)]
    off = np.pad(off, ((0, 0), (0, -off.shape[1] % PAIR)))
    words = [k_means(off[:, d:d + PAIR], WORDS, 4, rng) for d in range(0, off.shape[1], PAIR)]
    words = np.stack([np.concatenate([w, np.repeat(w[:1], WORDS - len(w), axis=0)]) for w in words])
    kind = corpus.schema["id"].dataType.simpleString()

    def code(batches):
        for batch in batches:
            x = placed_vectors(topk.to_matrix(batch["vec"]), metric)
            cell = nearest(x, centres) if len(x) else np.zeros(0, int)
            out = encoded(x, cell, centres, words) if len(x) else np.zeros((0, len(words)), np.uint8)
            miss = np.sqrt(((x - decoded(out, cell, centres, words)) ** 2).sum(axis=1))
            far = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
            yield pa.record_batch([pa.array(cell, pa.int32()), batch["rep"], batch["ids"], batch["vec"],
                                   pa.array([c.tobytes() for c in out], pa.binary()), pa.array(miss), pa.array(far)],
                                  ["cell", "rep", "ids", "vec", "code", "miss", "far"])

    coded = found.mapInArrow(code, f"cell int, rep {kind}, ids array<{kind}>, vec array<float>, code binary, miss double, "
                                   "far double")
    coded = coded.repartition("cell", F.pmod(F.xxhash64("rep"), F.lit(8)))  # few files per cell
    entries = materialize(coded.sortWithinPartitions("cell"), "codes")
    radius = np.full(len(centres), -np.inf)
    for r in entries.groupBy("cell").agg(F.max("far").alias("far")).collect():  # one row per cell, a parameter
        radius[r.cell] = r.far
    return CodeIndex(entries, centres, radius, words, metric, most_k)


def goodness(p: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Scores of which more is better, in double precision."""
    if metric != "L2":
        return p @ x.T
    return -np.sqrt(np.maximum((p ** 2).sum(axis=1)[:, None] - 2 * (p @ x.T) + (x ** 2).sum(axis=1), 0.0))


def reach(p: np.ndarray, x: np.ndarray, miss: np.ndarray, metric: str) -> np.ndarray:
    """How far a score can be off: what a vector misses, times the probe's length for products, and rounding."""
    lengths = np.sqrt((p ** 2).sum(axis=1))[:, None]
    size = np.sqrt((x ** 2).sum(axis=1)) + miss
    if metric == "L2":
        # a distance comes from a difference of squares: rounding is of the size of the squares' root
        return miss + 1e-7 * (lengths + size)
    return lengths * (miss + SLACK * size)


def code_hits(asked: DataFrame, index: CodeIndex, k: int, tile_bytes: int = vs.TILE_BYTES,
              smallest_tile: int = vs.SMALLEST_TILE) -> tuple[DataFrame, DataFrame]:
    """(exact hits ``key, id, rank, score``; pairs ``key, rep`` whose vectors were read, to be measured on small tables)
    for ``asked(key, pv)``."""
    if not 1 <= k <= index.most_k:
        raise ValueError(f"k must be between 1 and the index's {index.most_k}, not {k}")
    metric, centres, radius, words = index.metric, index.centres, index.radius, index.words
    key = asked.schema["key"]

    def usable(batch):
        p = placed_vectors(topk.to_matrix(batch["pv"]), "IP")
        if len(p) and np.isfinite(radius).any() and p.shape[1] != centres.shape[1]:
            raise ValueError(f"probe width {p.shape[1]} differs from corpus width {centres.shape[1]}")
        length = np.sqrt((p ** 2).sum(axis=1)) if len(p) else np.zeros(0)
        ok = np.isfinite(length) & ((length > 0) | (metric != "COSINE"))
        p = p[ok]
        return batch.filter(pa.array(ok)), p / length[ok][:, None] if metric == "COSINE" else p

    def home(batches):
        for batch in batches:
            batch, p = usable(batch)
            if len(p) and np.isfinite(radius).any():
                near = np.where(np.isfinite(radius), goodness(p, centres, metric), -np.inf).argmax(axis=1)
                yield pa.record_batch([pa.array(near, pa.int32()), batch["key"], batch["pv"]], ["grp", "key", "pv"])

    probe_type = [T.StructField("key", key.dataType), T.StructField("pv", T.ArrayType(T.FloatType()))]
    at_home = asked.where("pv IS NOT NULL").mapInArrow(home, T.StructType([T.StructField("grp", T.IntegerType()), *probe_type]))
    coded = index.entries.select(F.col("cell").alias("grp"), F.col("rep").alias("id"), "code", "miss", "vec",
                                 F.slice("ids", 1, k).alias("ids"))
    # a tile is bounded by what its codes become in memory: double precision, and the vectors beside them
    sizes = dict(groups=len(centres), tile_bytes=tile_bytes, smallest_tile=smallest_tile, width=F.lit(3 * centres.shape[1]))

    def bounds(left, right):
        p = placed_vectors(topk.to_matrix(left["pv"]), metric)
        codes = np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8).reshape(len(right), -1)
        cell = np.full(len(right), right["grp"][0].as_py())
        x, miss = decoded(codes, cell, centres, words), right["miss"].to_numpy()
        for at in range(0, len(p), max(1, CELLS_AT_ONCE // max(1, len(x)))):
            part = p[at:at + max(1, CELLS_AT_ONCE // max(1, len(x)))]
            yield at, goodness(part, x, metric), reach(part, x, miss, metric)

    def kth(score: np.ndarray) -> np.ndarray:
        if score.shape[1] < k:
            return np.full(len(score), -np.inf)
        return np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]

    def exact(p: np.ndarray, v: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Scores of pairs in double precision, a bounded number of vectors at a time; more is better."""
        pn, vn = (np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)) for m in (p, v))
        done = [np.zeros(0)]
        for at in range(0, len(row), PAIRS_AT_ONCE):
            r, c = row[at:at + PAIRS_AT_ONCE], column[at:at + PAIRS_AT_ONCE]
            done.append(topk._exact(p[r], v[c], pn[r], vn[c], metric))
        return np.concatenate(done) * (-1 if metric == "L2" else 1)

    def likeliest(p: np.ndarray, v: np.ndarray, at: int, good: np.ndarray) -> np.ndarray:
        """Per probe the exact score that the k best vectors of the tile reach at least: the lowest of its k best by code."""
        if good.shape[1] < k:
            return np.full(len(good), -np.inf)
        column = np.argpartition(good, good.shape[1] - k, axis=1)[:, good.shape[1] - k:]
        row = np.repeat(np.arange(len(good)) + at, k)
        return exact(p, v, row, column.ravel()).reshape(len(good), k).min(axis=1)

    def floor(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            p, v = topk.to_matrix(left["pv"]), topk.to_matrix(right["vec"])
            found = [np.maximum(kth(good - off), likeliest(p, v, at, good)) for at, good, off in bounds(left, right)]
        return pa.table({"key": left["key"], "floor": pa.array(np.concatenate(found) if found else np.full(len(left), -np.inf))})

    p, c, on = vs.tiles(at_home, coded, **sizes)
    floors = p.groupBy(*on).cogroup(c.groupBy(*on)).applyInArrow(floor, T.StructType([
        T.StructField("key", key.dataType), T.StructField("floor", T.DoubleType())])).groupBy("key").agg(
        F.max("floor").alias("floor"))
    floors = materialize(at_home.select("key", "pv").join(floors, "key", "left").select(
        "key", "pv", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")), "floors")

    def visit(batches):
        for batch in batches:
            at, p = usable(batch)
            if not len(p):
                continue
            best = goodness(p, centres, metric) + reach(p, centres, np.where(np.isfinite(radius), radius, 0.0), metric)
            row, cell = np.nonzero(np.isfinite(radius) & (best >= at["floor"].to_numpy()[:, None]))
            take = pa.array(row)
            yield pa.record_batch([pa.array(cell, pa.int32()), *[at[c].take(take) for c in ("key", "pv", "floor")]],
                                  ["grp", "key", "pv", "floor"])

    level = T.StructField("floor", T.DoubleType())
    visits = floors.mapInArrow(visit, T.StructType([T.StructField("grp", T.IntegerType()), *probe_type, level]))
    rep = T.StructField("rep", coded.schema["id"].dataType)

    def read(left: pa.Table, right: pa.Table):
        """(probe rows, columns, exact scores) of the tile's pairs whose vectors are read, a bounded block at a time."""
        if not len(left) or not len(right):
            return
        p, v, level = topk.to_matrix(left["pv"]), topk.to_matrix(right["vec"]), left["floor"].to_numpy()
        for at, good, off in bounds(left, right):
            least = np.maximum(level[at:at + len(good)], np.maximum(kth(good - off), likeliest(p, v, at, good)))
            row, column = np.nonzero(good + off >= least[:, None])
            yield row + at, column, exact(p, v, row + at, column)

    def decide(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, columns, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        place = np.argsort(np.argsort(vs._ids(right["id"]), kind="stable"), kind="stable")
        for row, column, score in read(left, right):
            order = np.lexsort((place[column], -score, row))
            row, column, score = row[order], column[order], score[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            rows.append(row[best])
            columns.append(column[best])
            scores.append(score[best])
        score = np.concatenate(scores) * (-1 if metric == "L2" else 1)
        return pa.table({"key": left["key"].take(pa.array(np.concatenate(rows))),
                         "ids": right["ids"].take(pa.array(np.concatenate(columns))), "score": pa.array(score)})

    def looked_at(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = [(row, column) for row, column, _ in read(left, right)]
        rows, columns = ([np.zeros(0, np.int64), *part] for part in zip(*pairs)) if pairs else ([np.zeros(0, np.int64)],) * 2
        return pa.table({"key": left["key"].take(pa.array(np.concatenate(rows))),
                         "rep": right["id"].take(pa.array(np.concatenate(columns)))})

    p, c, on = vs.tiles(visits, coded, **sizes)
    met = p.groupBy(*on).cogroup(c.groupBy(*on))
    scored = met.applyInArrow(decide, T.StructType([probe_type[0], T.StructField("ids", T.ArrayType(rep.dataType)),
                                                    T.StructField("score", T.DoubleType())]))
    hits = scored.select("key", F.explode("ids").alias("id"), "score")
    return vs.best(hits, metric, k), met.applyInArrow(looked_at, T.StructType([probe_type[0], rep]))
