"""Stage 1 and 2 as batch plans: alarm -> section -> context -> work order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import text, triage
from faultline.functions.clock import plus_millis
from faultline.operators.models import template_reply
from faultline.operators.vector_search import vector_search
from faultline.schemas import CONTEXT, WORK_ORDER
from faultline.sources import tables


def enrich(hits: DataFrame, high: float = triage.HIGH, medium: float = triage.MEDIUM,
           t_context: Column | None = None, more: list[str] | None = None) -> DataFrame:
    """Hits (alarm columns, section columns, score) -> the 22 columns of the context record, and those in ``more``.

    Thresholds see the score before it is narrowed to FLOAT. ``t_context`` is the stage's stamp.
    """
    severity, criticality = F.col("severity"), F.col("criticality")
    stamped = hits.withColumn("t_context", t_context) if t_context is not None else hits
    derived = {
        "matched_section": F.col("section"),
        "score": F.col("score").cast("float"),
        "match_confidence": triage.match_confidence(F.col("score"), high, medium),
        "priority": triage.priority(severity, criticality),
        "queue": triage.queue(F.col("category")),
        "sla_due": triage.sla_due(F.col("alarm_time"), severity, criticality),
        "t_alarm": F.col("alarm_time"),
        "planner_input": text.planner_input(),
    }
    return stamped.select(*[derived.get(c, F.col(c)).alias(c) for c in CONTEXT.names], *(more or []))


def hits(spark: SparkSession, sf_dir: str, k: int = 1, how: str = "inner", **options) -> DataFrame:
    """Every alarm with its k best sections.

    Alarms share vectors, so the vectors are searched once each and alarms look their hits up. The hits are stored, so that
    of the sections' texts only those hit are moved.
    """
    found = vector_search(tables.probes(spark, sf_dir), tables.manual(spark, sf_dir), "alarm_vector", "vec",
                          k=k, key="probe_id", rows_of=lambda ids: tables.manual(spark, sf_dir, only=ids), **options)
    return tables.alarms_with(spark, sf_dir, found, how)


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(tables.context_clock(hits(spark, sf_dir)), tables.HIGH, tables.MEDIUM)


def planned(ctx: DataFrame) -> DataFrame:
    """Template planner with a deterministic clock, over every context: its columns and the two of the plan."""
    id_ = F.col("alarm_id").cast("long")
    reply = template_reply(F.col("match_confidence") != "low", F.col("doc_ref"), F.col("queue"), F.col("severity"))
    return ctx.withColumn("ai_work_order", reply).withColumn(
        "t_action", plus_millis(F.col("t_alarm"), 1300 + id_ % 700 + id_ % 1500))


def work_orders(ctx: DataFrame) -> DataFrame:
    return planned(ctx).select(*WORK_ORDER.names)
