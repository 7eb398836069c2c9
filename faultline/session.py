"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job here relies on; cluster sizing stays with the cluster."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without one (tests): it then gets a scratch folder of its own. On a
    cluster a missing setting is an error, because an executor-local path would not survive the
    loss of the executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    known = context.getCheckpointDir()
    if known is None:
        known = tempfile.mkdtemp(prefix="faultline-")
        context.setCheckpointDir(known)
    return known.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one for one run of a streaming query."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a stage boundary. What several branches of
    a plan read is computed once, survives lost executors, and comes back columnar with known size."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
