"""Approximate search: corpus vectors grouped into cells, a probe looks into its nearest ones only."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators import vector_search as vs
from faultline.session import materialize, run_dir


def _geometry(metric: str) -> tuple[str, str]:
    """(distance of the clustering, metric that ranks cells): cosine sees directions only."""
    return ("cosine", "COSINE") if metric == "COSINE" else ("euclidean", "L2")


def build_cells(corpus: DataFrame, vec: str, cells: int, metric: str = "COSINE", seed: int = 7,
                iterations: int = 10, path: str | None = None,
                centroids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(corpus + ``cell``, centroids(cell, centroid)), fitted on all rows, or placed by given ``centroids``. The pair is
    an index: built once, it is passed to ``vector_search(..., built=)`` as often as needed.

    The corpus is written partitioned by cell, to ``path`` or the shared folder, and read back: an
    index is built once and its readers prune to the cells they need. Rows without a vector, or with
    a zero vector under cosine, are in no cell. The centroids are ``cells`` rows, a parameter.
    """
    distance, _ = _geometry(metric)
    usable = F.exists(vec, lambda x: x != 0) if metric == "COSINE" else F.col(vec).isNotNull()
    if centroids is not None:
        path = path or run_dir(corpus.sparkSession, "cells")
        nearest = vs.ResidentIndex(centroids, "centroid", "cell", _geometry(metric)[1], 1)
        placed = corpus.where(usable).withColumn("__near", nearest.hits(F.col(vec).cast("array<float>")))
        placed = placed.withColumn("cell", F.col("__near")[0]["id"]).drop("__near")
        placed.write.mode("overwrite").partitionBy("cell").parquet(path)
        return corpus.sparkSession.read.schema(placed.schema).parquet(path), centroids
    featured = corpus.where(usable).withColumn("__features", array_to_vector(vec))
    model = KMeans(k=cells, seed=seed, maxIter=iterations, distanceMeasure=distance, featuresCol="__features",
                   predictionCol="cell").fit(featured.select("__features"))
    path = path or run_dir(corpus.sparkSession, "cells")
    placed = model.transform(featured).drop("__features")
    placed.write.mode("overwrite").partitionBy("cell").parquet(path)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centroids = corpus.sparkSession.createDataFrame(rows, "cell INT, centroid ARRAY<FLOAT>")
    return corpus.sparkSession.read.schema(placed.schema).parquet(path), centroids


def route(probes: DataFrame, centroids: DataFrame, probe: str, nprobe: int, metric: str = "COSINE") -> DataFrame:
    """``probes`` repeated for each of their ``nprobe`` nearest cells, with column ``cell``."""
    index = vs.ResidentIndex(centroids, "centroid", "cell", _geometry(metric)[1], nprobe)
    near = probes.withColumn("__near", index.hits(F.col(probe)))
    return near.select(*probes.columns, F.explode(F.col("__near.id")).alias("cell"))


def routed_hits(routed: DataFrame, placed: DataFrame, metric: str, k: int, cells: int) -> DataFrame:
    """Exact re-ranking inside the visited cells; a cell of any size is cut into tiles."""
    p = routed.select(F.col("cell").alias("grp"), "key", "pv")
    c = placed.select(F.col("cell").alias("grp"), "id", "cv")
    return vs.best(vs.tiled_hits(p, c, metric, k, groups=cells), metric, k)


def cell_hits(asked: DataFrame, slim: DataFrame, metric: str, k: int, cells: int, nprobe: int,
              built: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Hits through an index (rows ``id, cv, cell``; centroids); without one it is built for this search alone."""
    placed, centroids = built or build_cells(slim, "cv", cells, metric)
    return routed_hits(route(asked, centroids, "pv", nprobe, metric), placed, metric, k, cells)


def recall(found: DataFrame, exact: DataFrame, key: str, corpus_key: str = "id") -> DataFrame:
    """Share of the exact hits that were found."""
    pairs = [key, corpus_key]
    seen = found.select(*pairs).withColumn("__seen", F.lit(1))
    return exact.select(*pairs).join(seen, pairs, "left").agg(
        (F.count("__seen") / F.count("*")).alias("recall"))


def enough_cells(asked: DataFrame, placed: DataFrame, centroids: DataFrame, metric: str, k: int, cells: int,
                 least: float = 0.9) -> tuple[int, float]:
    """(fewest visited cells, recall@k) of an index whose recall over all of ``asked`` is measured to be at least
    ``least``, against every row that the index holds."""
    exact = materialize(vs.best(vs.tiled_hits(asked, placed.select("id", "cv"), metric, k), metric, k), "exact")
    reached = 0.0
    for nprobe in range(1, cells + 1):
        found = routed_hits(route(asked, centroids, "pv", nprobe, metric), placed, metric, k, cells)
        reached = recall(found, exact, "key").first().recall
        if reached is None or reached >= least:
            return nprobe, reached
    raise ValueError(f"recall {reached} in all {cells} cells, below {least}")
