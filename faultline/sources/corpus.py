"""Corpus tables: curated and extra sections, their ids and vectors, and when to embed again."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.conform import check_dim, conform
from faultline.operators.corpus import number_rows
from faultline.operators.models import ModelSpec, ml_predict
from faultline.schemas import MANUAL, struct

SECTION = struct("content STRING, category STRING, section STRING, doc_ref STRING, severity INT")


def read_corpus(spark: SparkSession, path: str, schema: T.StructType = MANUAL, key: str = "id",
                model: ModelSpec | None = None, dim: int | None = None) -> DataFrame:
    """The corpus at ``path``. With the ``model`` and width of the probes, a corpus that another model embedded, or whose
    seeding did not end, is an error: distances between vectors of different models mean nothing."""
    if model is not None:
        held, asked = fingerprint(spark, path), model.fingerprint(dim)
        if held != asked:
            raise ValueError(f"the corpus at {path} was embedded by {held or 'no known model'}, the probes by {asked}")
    return conform(spark.read.parquet(path), schema, key)


def extra_sections(spark: SparkSession, path: str, enabled: bool | None = None) -> DataFrame:
    """Sections from JSON files holding arrays ``[content, category, title, doc_ref, severity]``.

    Missing path: no rows. ``CORPUS_EXTRA=0`` in the environment turns them off.
    """
    if enabled is None:
        enabled = os.environ.get("CORPUS_EXTRA", "1") != "0"
    nothing = spark.createDataFrame([], SECTION).withColumn("ord", F.lit(0).cast("long"))
    if not enabled:
        return nothing
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing
    rows = F.from_json("value", "ARRAY<ARRAY<STRING>>")
    each = files.select(F.posexplode(rows).alias("ord", "row"))
    named = [F.col("row")[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(SECTION.fields)]
    return each.select(*named, F.col("ord").cast("long").alias("ord"))


def assemble(curated: DataFrame, extra: DataFrame) -> DataFrame:
    """All sections in order, curated first, with ids 0..n-1. Both sides carry ``ord``."""
    both = curated.withColumn("source", F.lit(0)).unionByName(extra.withColumn("source", F.lit(1)))
    return number_rows(both, ["source", "ord", "doc_ref"]).drop("source", "ord")


def fingerprint(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.json(f"{path}_meta", schema="fingerprint STRING").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.fingerprint if row else None


def put_fingerprint(spark: SparkSession, path: str, value: str | None) -> None:
    meta = spark.createDataFrame([(value,)], "fingerprint STRING")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}_meta")


def seed_corpus(sections: DataFrame, path: str, model: ModelSpec, dim: int, batch_size: int = 100) -> bool:
    """Embed the prose of ``sections`` and replace the corpus at ``path``; True when it was written.

    Skipped while the fingerprint of model and width stays the same. The fingerprint is withdrawn before the rows are
    replaced and set after them, so a run that breaks off in between is never taken for a finished one. Only ``content`` is embedded: a
    title would let a probe match the label instead of what the section says.
    """
    spark = sections.sparkSession
    print_ = model.fingerprint(dim)
    if fingerprint(spark, path) == print_:
        return False
    embedded = ml_predict(sections, model, "content", out="vec", batch_size=batch_size, error="failure")
    embedded = embedded.checkpoint()  # the model is called once, whatever reads its output below
    failed = embedded.where(F.col("failure").isNotNull()).first()
    if failed:
        raise ValueError(f"section {failed.id} was not embedded: {failed.failure}")
    checked = check_dim(embedded, "vec", dim).select(*MANUAL.names)
    put_fingerprint(spark, path, None)
    checked.write.mode("overwrite").parquet(path)
    put_fingerprint(spark, path, print_)
    return True
