"""The pipeline's records derived from the star-schema tables, whole tables throughout.

Alarms come from ``events``; the corpus is every row of ``documents`` with a vector of
``embeddings``; the probe vectors are all of ``embeddings``, each reversed, so that no probe finds
itself. As there are more documents than vectors, several sections share one vector: the copies that
a real manual has too.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.clock import plus_millis, to_millis
from faultline.functions.triage import shift_of
from faultline.operators.joins import lookup
from faultline.schemas import CATEGORIES, struct

# Thresholds measured for these vectors
HIGH, MEDIUM = 0.40, 0.34

ASSETS = ("PRESS-04", "MILL-11", "LATHE-02", "CNC-07", "WELD-03", "CONV-01")
LINES = ("LINE-A", "LINE-A", "LINE-B", "LINE-B", "LINE-C", "LINE-C")
EXPECTED = {"PURCHASE": "SM-0", "SIGNUP": "SM-1", "VIEW": "SM-2", "CLICK": None}


# Declared, so that opening a table needs no job to look into its files
SCHEMAS = {
    "events": struct("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"),
    "documents": struct("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"),
    "embeddings": struct("vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"),
    "part": struct("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(index: Column, values) -> Column:
    steps = enumerate(values[:-1])
    chain = reduce(lambda c, iv: c.when(index == iv[0], iv[1]), steps, F)
    return chain.otherwise(values[-1])


def with_probe(events: DataFrame, vectors: Column) -> DataFrame:
    """Events with the ``probe_id`` of their alarm (NULL for one event in fifty)."""
    return events.withColumn("probe_id", F.when(F.col("event_id") % 50 != 49, F.col("event_id") % vectors))


def alarm_columns() -> list[Column]:
    """The columns of an alarm, from those of its event."""
    unit = F.col("user_id") % 6
    rank = F.col("event_id") % 10
    return [
        F.col("event_id").cast("string").alias("alarm_id"),
        _pick(unit, ASSETS).alias("asset_id"),
        _pick(unit, LINES).alias("line_id"),
        F.upper("event_type").alias("fault_code"),
        F.concat(F.lit("report of "), "event_type", F.lit(" by unit "), F.col("user_id").cast("string"))
        .alias("alarm_text"),
        F.col("value").alias("vibration_mms"),
        (34 + F.col("event_id") % 60).cast("int").alias("temp_c"),
        (96 + F.col("event_id") % 80).cast("int").alias("pressure_bar"),
        F.when(rank < 5, "line_critical").when(rank < 8, "standby").otherwise("redundant").alias("criticality"),
        shift_of(F.col("ts")).alias("shift"),
        to_millis(F.col("ts")).alias("alarm_time"),
    ]


def alarms_from(events: DataFrame, vectors: Column) -> DataFrame:
    """Alarm columns plus ``probe_id``."""
    return with_probe(events, vectors).select(*alarm_columns(), "probe_id")


def alarms_with(spark: SparkSession, sf_dir: str, found: DataFrame, how: str) -> DataFrame:
    """``alarms`` that look up their rows of ``found(probe_id, ...)``. Events are narrower than alarms, so it is they that
    move to the join."""
    events = with_probe(read(spark, sf_dir, "events"), read(spark, sf_dir, "embeddings").agg(F.count("*")).scalar())
    more = [c for c in found.columns if c != "probe_id"]
    return lookup(events, found, "probe_id", how).select("probe_id", *alarm_columns(), *more)


def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = read(spark, sf_dir, "embeddings").agg(F.count("*")).scalar()
    return alarms_from(read(spark, sf_dir, "events"), count)


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("probe_id"), F.reverse("embedding").alias("alarm_vector"))


def manual(spark: SparkSession, sf_dir: str, stretched: bool = False, only: DataFrame | None = None) -> DataFrame:
    """One section per document. ``stretched`` scales the vectors, for metrics that see length. ``only(id)`` leaves out the
    documents it does not name before their texts are moved."""
    emb = read(spark, sf_dir, "embeddings")
    count = emb.agg(F.count("*")).scalar()
    docs = read(spark, sf_dir, "documents")
    if only is not None:
        docs = docs.join(only.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    docs = docs.withColumn("vec_id", F.col("doc_id") % count)
    rank = F.col("doc_id") % 10
    vec = F.col("embedding")
    if stretched:
        vec = F.transform(vec, lambda x: (x * (1 + F.col("doc_id") % 3)).cast("float"))
    return docs.join(emb, "vec_id").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("content"),
        _pick(F.col("label") % 6, CATEGORIES).alias("category"),
        F.concat(F.lit("Section "), F.col("doc_id").cast("string")).alias("section"),
        F.concat(F.lit("SM-"), F.col("doc_id").cast("string")).alias("doc_ref"),
        F.when(rank < 3, 1).when(rank < 7, 2).when(rank < 9, 3).otherwise(4).alias("severity"),
        vec.alias("vec"),
    )


def with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms with their own probe vector (precomputed provider)."""
    from faultline.operators.models import precomputed
    return precomputed(alarms(spark, sf_dir), probes(spark, sf_dir), "probe_id")


def context_clock(df: DataFrame) -> DataFrame:
    """Deterministic stage-1 stamp in place of the wall clock."""
    return df.withColumn("t_context", plus_millis(F.col("alarm_time"), 300 + F.col("alarm_id").cast("long") % 700))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human actions from the events of every type; neighbouring events act on one incident."""
    e = F.col("event_id")
    what = _pick(e % 7, ("assign", "define", "IN_PROGRESS", "RESOLVED", "REJECTED", "CLOSED", "escalate"))
    user = F.col("user_id").cast("string")
    return read(spark, sf_dir, "events").select(
        e.alias("action_id"),
        (e - e % 4).cast("string").alias("incident_id"),
        what.alias("what"),
        F.when(F.col("user_id") % 5 == 0, "  ").otherwise(F.concat(F.lit(" tech-"), user)).alias("assignee"),
        F.when(F.col("user_id") % 4 == 0, "").otherwise(F.concat(F.lit("replace unit "), user)).alias("manual_action"),
        F.when(F.col("user_id") % 3 == 0, "   ").otherwise(F.concat(F.lit(" note by "), user, F.lit(" "))).alias("note"),
        F.lit("planner").alias("actor"),
        (to_millis(F.col("ts")) + F.expr("INTERVAL 1 HOUR")).alias("acted_at"),
    )
