"""Top-k vector search: every probe row with its k best corpus rows.

``resident``  the corpus vectors fit the stated bound: they are shipped once and each probe row is
              scored where it is, without a shuffle. Works on streams too.
``blocked``   any size: probes and corpus are cut into tiles, each pair of tiles is one task's
              matrix product that emits only its k best, and the tiles' hits are merged.
``cells``     approximate, see ``cells.py``.
``codes``     exact, through an index of quantised codes, see ``codes.py``.
``auto``      resident when the measured size is within the bound, else blocked; the size that counts is that of the
              distinct vectors, of which a corpus over the bound is stored first.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators import topk
from faultline.operators.joins import lookup
from faultline.schemas import METRICS
from faultline.session import materialize

RESIDENT_BYTES = 64 << 20
TILE_BYTES = 64 << 20
SMALLEST_TILE = 1024


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; allowed: {', '.join(METRICS)}")
    return metric


def check_vector_column(df: DataFrame, name: str) -> None:
    """``name`` must be one top-level array column of FLOAT or DOUBLE."""
    if name not in df.columns:
        raise ValueError(f"no top-level column {name!r}; columns: {', '.join(df.columns)}")
    kind = df.schema[name].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        raise ValueError(f"column {name!r} is {kind.simpleString()}, not an array of float or double")


def _as_float(name: str) -> Column:
    return F.col(name).cast("array<float>")


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy() if not pa.types.is_string(column.type) else np.array(column.to_pylist(), dtype=object)


class ResidentIndex:
    """Corpus vectors of bounded size, shipped to the executors once and reused by every batch."""

    def __init__(self, corpus: DataFrame, vec: str, corpus_key: str, metric: str, k: int,
                 max_bytes: int = RESIDENT_BYTES, size: int | None = None):
        self.metric, self.k = check_metric(metric), k
        self.id_type = corpus.schema[corpus_key].dataType
        slim = corpus.where(F.col(vec).isNotNull()).select(
            F.col(corpus_key).alias("id"), _as_float(vec).alias("vec"))
        size = measure(slim) if size is None else size  # measured already
        if size > max_bytes:
            raise ValueError(f"corpus vectors take {size} bytes, over the bound of {max_bytes}")
        table = slim.toArrow()
        tile = topk.pack(_ids(table["id"]), topk.to_matrix(table["vec"]), metric, k)
        self._shipped = corpus.sparkSession.sparkContext.broadcast(tile)

    def hits(self, probe: Column) -> Column:
        """array<struct<id, rank, score>> for one probe column; NULL probe -> NULL."""
        shipped, metric, k = self._shipped, self.metric, self.k
        returns = T.ArrayType(T.StructType([
            T.StructField("id", self.id_type), T.StructField("rank", T.IntegerType()),
            T.StructField("score", T.DoubleType())]))
        id_type = pa.string() if isinstance(self.id_type, T.StringType) else None

        def find(probes: pa.Array) -> pa.Array:
            tile = shipped.value
            given = probes.is_valid().to_numpy(zero_copy_only=False)
            row, pos, score, rank = topk.search_distinct(
                tile, topk.to_matrix(probes.drop_null()), metric, k)
            counts = np.zeros(len(probes), np.int32)
            counts[given] = np.bincount(row, minlength=int(given.sum()))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.array(tile["ids"][pos], type=id_type)
            entries = pa.StructArray.from_arrays(
                [ids, pa.array(rank, pa.int32()), pa.array(score, pa.float64())], ["id", "rank", "score"])
            return pa.ListArray.from_arrays(pa.array(offsets), entries, mask=pa.array(~given))

        find.__annotations__ = {"probes": pa.Array, "return": pa.Array}
        return F.arrow_udf(find, returnType=returns).asNondeterministic()(probe)


def measure(slim: DataFrame) -> int:
    """Bytes of the vectors of ``slim(id, vec)``: rows x widest vector x 4, plus the ids."""
    row = slim.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("w")).first()
    return row.n * (row.w * 4 + 16)


def smallest_of_equal(slim: DataFrame, k: int) -> DataFrame:
    """Of equal vectors of ``slim(id, cv)`` the k smallest ids: no other can be a hit (see ``topk.pack``). A task keeps no
    more of them than that before the shuffle, so a vector of many copies does not land in one task. Rows are sorted by a
    hash first: vectors are compared only where it is equal."""
    hashed = slim.withColumn("__hash", F.xxhash64("cv"))
    nth = F.row_number().over(Window.partitionBy("__hash", "cv").orderBy("id"))
    return hashed.withColumn("__nth", nth).where(F.col("__nth") <= k).drop("__nth", "__hash")


def store_hits(hits: DataFrame, key: str, max_bytes: int = RESIDENT_BYTES) -> tuple[DataFrame, DataFrame]:
    """``hits`` written once, and the distinct ids they name, as ``key``. The ids are marked to be shipped where their
    measured size is within the bound."""
    hits = materialize(hits, "hits")
    ids = hits.where(F.col("__id").isNotNull()).select(F.col("__id").alias(key)).distinct()
    size = ids.agg(F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 64), F.lit(0))).first()[0]
    return hits, F.broadcast(ids) if size <= max_bytes else ids


def tiles(probes: DataFrame, corpus: DataFrame, groups: int | None = None, tile_bytes: int = TILE_BYTES,
          smallest_tile: int = SMALLEST_TILE, width: Column | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides repeated over the tiles they meet in, and the columns that name a pair of tiles.

    Tiles are cut by a hash of the row's own ``key`` or ``id``, so rows of any origin fall into tiles of about equal
    size. A tile holds at most ``tile_bytes`` of ``width`` numbers a row (the widest ``cv``); when there is less work than
    that, tiles shrink until every core has some. With ``groups`` both sides carry ``grp``, the cell of an index
    (that many of them, a parameter), and only rows of one cell meet; each cell is tiled by its own size.
    """
    cores = probes.sparkSession.sparkContext.defaultParallelism

    def number(rows: Column, n_probes: Column, n_corpus: Column, width: Column) -> Column:
        most = F.greatest(F.lit(float(smallest_tile)), F.lit(float(tile_bytes)) / (width * 4))
        even = F.sqrt(n_probes.cast("double") * n_corpus * (groups or 1) / (4.0 * cores))
        return F.ceil(rows / F.least(most, F.greatest(F.lit(float(smallest_tile)), even)))

    count, widest = F.count("*"), F.max(F.size("cv")) if width is None else F.max(width)
    if groups:
        sizes = probes.groupBy("grp").agg(count.alias("np")).join(
            corpus.groupBy("grp").agg(count.alias("nc"), widest.alias("w")), "grp")
        measures = F.col("np"), F.col("nc"), F.col("w")
        counts = F.broadcast(sizes.select(  # one row per group: bounded by the parameter
            "grp", number(F.col("np"), *measures).alias("p_tiles"), number(F.col("nc"), *measures).alias("c_tiles")))
        probes, corpus, on = probes.join(counts, "grp"), corpus.join(counts, "grp"), ["grp"]
    else:
        n_probes, n_corpus = probes.agg(count).scalar(), corpus.agg(count).scalar()
        measures = n_probes, n_corpus, corpus.agg(widest).scalar()
        p_tiles, c_tiles = number(n_probes, *measures), number(n_corpus, *measures)
        probes, corpus = [df.withColumn("p_tiles", p_tiles).withColumn("c_tiles", c_tiles) for df in (probes, corpus)]
        on = []

    def numbers(tile_count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(tile_count) - 1))

    p = probes.withColumn("p_tile", F.pmod(F.xxhash64("key"), "p_tiles")).where("c_tiles > 0").withColumn(
        "c_tile", numbers("c_tiles")).drop("p_tiles", "c_tiles")
    c = corpus.withColumn("c_tile", F.pmod(F.xxhash64("id"), "c_tiles")).where("p_tiles > 0").withColumn(
        "p_tile", numbers("p_tiles")).drop("p_tiles", "c_tiles")
    return p, c, [*on, "p_tile", "c_tile"]


def tiled_hits(probes: DataFrame, corpus: DataFrame, metric: str, k: int,
               groups: int | None = None, tile_bytes: int = TILE_BYTES,
               smallest_tile: int = SMALLEST_TILE) -> DataFrame:
    """Exact top-k: probes(key, pv) x corpus(id, cv) -> (key, id, score), per pair of ``tiles``."""
    p, c, on = tiles(probes, corpus, groups, tile_bytes, smallest_tile)
    out = T.StructType([
        T.StructField("key", probes.schema["key"].dataType),
        T.StructField("id", corpus.schema["id"].dataType),
        T.StructField("score", T.DoubleType())])

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        tile = topk.pack(_ids(right["id"]), topk.to_matrix(right["cv"]), metric, k)
        row, pos, score, _ = topk.search(tile, topk.to_matrix(left["pv"]), metric, k)
        return pa.table({
            "key": left["key"].take(pa.array(row)),
            "id": pa.array(tile["ids"][pos], type=right["id"].type),
            "score": pa.array(score, pa.float64())})

    return p.groupBy(*on).cogroup(c.groupBy(*on)).applyInArrow(match, out)


def best(hits: DataFrame, metric: str, k: int) -> DataFrame:
    """Merge per-tile hits (key, id, score) into ranks; at most k per tile reach this window."""
    order = F.col("score").asc() if metric == "L2" else F.col("score").desc()
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(order, "id")))
    return ranked.where(F.col("rank") <= k).select("key", "id", "rank", "score")


def vector_search(probes: DataFrame, corpus: DataFrame, probe: str, vec: str, k: int = 1,
                  metric: str = "COSINE", where: Column | str | None = None, how: str = "inner",
                  key: str = "alarm_id", corpus_key: str = "id", strategy: str = "auto",
                  distinct_by: str | None = None, prefix: str = "", payload: list[str] | None = None,
                  index: ResidentIndex | None = None, cells: int = 16, nprobe: int = 4,
                  built=None, tile_bytes: int = TILE_BYTES, smallest_tile: int = SMALLEST_TILE,
                  rows_of: Callable[[DataFrame], DataFrame] | None = None, together: bool = False) -> DataFrame:
    """Columns of ``probes``, columns of ``corpus``, ``rank``, and ``score`` (DOUBLE) last.

    ``where`` restricts the corpus before the search. A NULL probe has no hits; with ``how='left'``
    its row stays, padded with NULLs. Every row has its own hits, also where ``key`` repeats, and the same ones under
    every exact strategy. ``distinct_by`` names a column that determines the probe vector: each distinct value is then
    searched once and its hits are looked up; else that is done by a digest of the vector. ``payload`` limits
    the corpus columns that come back. ``rows_of`` (batch only) is for wide payloads: the probes are spread over all
    cores, the hits are written to the shared folder, and the payload comes from the corpus rows that ``rows_of`` gives
    for the ids that were hit, so that it can drop the others before it moves their texts. ``together``: the payload comes by
    merging, also where it could be broadcast, so that rows with one payload leave a task one after the other and what is
    written of them compresses well. COSINE and IP: larger is better; L2 is the plain (not squared) distance, smaller is
    better. Ties go to the smaller ``corpus_key``.
    """
    check_metric(metric)
    check_vector_column(probes, probe)
    check_vector_column(corpus, vec)
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    if where is not None:
        corpus = corpus.where(where)
    keep = payload if payload is not None else corpus.columns
    named = [F.col(c).alias(prefix + c) for c in keep]
    clash = sorted(set(probes.columns) & ({prefix + c for c in keep} | {"rank", "score"}))
    if clash:
        raise ValueError(f"columns on both sides of the search: {', '.join(clash)}; pass prefix=")

    probes = probes.withColumn(probe, _as_float(probe))
    slim = corpus.where(F.col(vec).isNotNull()).select(
        F.col(corpus_key).alias("id"), _as_float(vec).alias("cv"))
    size = None
    if strategy == "auto" and index is None:
        size = measure(slim.withColumnRenamed("cv", "vec"))
        if size > RESIDENT_BYTES:  # stored: the measure and the tiles read it
            slim = materialize(smallest_of_equal(slim, k), "vectors")
            size = measure(slim.withColumnRenamed("cv", "vec"))
    if strategy == "auto":
        strategy = "resident" if size is None or size <= RESIDENT_BYTES else "blocked"
    if strategy == "resident" and index is None:
        index = ResidentIndex(slim, "cv", "id", metric, k, size=size)

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(corpus_key).alias("__id"), *named)

    def store(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
        hits, ids = store_hits(hits, corpus_key)
        rows = rows_of(ids)
        return hits, keyed(rows.where(where) if where is not None else rows)

    right = keyed(corpus)
    tail = [prefix + c for c in keep] + ["rank", "score"]

    if strategy == "resident" and distinct_by is None:
        if rows_of:
            probes = probes.repartition(4 * probes.sparkSession.sparkContext.defaultParallelism)
        found = probes.withColumn("__hits", index.hits(F.col(probe)))
        each = F.inline_outer("__hits") if how == "left" else F.inline("__hits")
        found = found.select(*probes.columns, each.alias("__id", "rank", "score"))
        if rows_of:
            found, right = store(found)
        found = lookup(found, right.hint("merge") if together else right, "__id", how)
        return found.select(*probes.columns, *tail)

    unit = distinct_by or "__unit"
    if distinct_by is None:
        # a key may stand on several rows with different vectors: hits belong to the vector, not to the key
        probes_in = probes.withColumn("__unit", F.md5(F.array_join(F.transform(
            probe, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ",")))
    else:
        probes_in = probes
    asked = probes_in.where(F.col(probe).isNotNull()).select(
        F.col(unit).alias("key"), F.col(probe).alias("pv")).dropDuplicates(["key"])
    if strategy == "resident":
        hits = asked.select("key", F.inline(index.hits(F.col("pv"))))
    elif strategy == "blocked":
        hits = best(tiled_hits(asked, slim, metric, k, tile_bytes=tile_bytes, smallest_tile=smallest_tile),
                    metric, k)
    elif strategy == "cells":
        from faultline.operators.cells import cell_hits
        hits = cell_hits(asked, slim, metric, k, cells, nprobe, built)
    elif strategy == "codes":
        from faultline.operators.codes import build_codes, code_hits
        held = built or build_codes(slim, cells, metric, max(k, 64))
        if held.metric != metric:
            raise ValueError(f"the index was built for {held.metric}, not {metric}")
        hits, _ = code_hits(asked, held, k, tile_bytes, smallest_tile)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    hits = hits.withColumnRenamed("id", "__id").withColumnRenamed("key", unit)
    if rows_of:
        hits, right = store(hits)
    matched = lookup(hits, right, "__id").drop("__id")
    return lookup(probes_in, matched.hint("merge") if together else matched, unit, how).select(*probes.columns, *tail)


def constant_search(corpus: DataFrame, vector: list[float], vec: str, k: int,
                    metric: str = "COSINE", where: Column | str | None = None,
                    corpus_key: str = "id") -> DataFrame:
    """Search for one literal vector: each task offers its k best, the k best of those remain."""
    check_metric(metric)
    check_vector_column(corpus, vec)
    if where is not None:
        corpus = corpus.where(where)
    slim = corpus.where(F.col(vec).isNotNull()).select(
        F.col(corpus_key).alias("id"), _as_float(vec).alias("cv"))
    out = T.StructType([T.StructField("id", corpus.schema[corpus_key].dataType),
                        T.StructField("score", T.DoubleType())])
    one = np.asarray([vector], dtype=np.float32)

    def offer(batches):
        for batch in batches:
            if batch.num_rows:
                ids = _ids(pa.chunked_array([batch["id"]]))
                tile = topk.pack(ids, topk.to_matrix(batch["cv"]), metric, k)
                _, pos, score, _ = topk.search(tile, one, metric, k)
                yield pa.record_batch([pa.array(tile["ids"][pos], type=batch["id"].type),
                                       pa.array(score, pa.float64())], ["id", "score"])

    order = F.col("score").asc() if metric == "L2" else F.col("score").desc()
    top = slim.mapInArrow(offer, out).orderBy(order, "id").limit(k)
    rest = corpus.withColumnRenamed(corpus_key, "id") if corpus_key != "id" else corpus
    # k rows, a parameter: bounded
    return rest.join(F.broadcast(top), "id").select(*rest.columns, "score")
