"""Work lists over the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.triage import priority_rank
from faultline.schemas import TERMINAL

# fixed values: the columns of a work list
LISTED = ["incident_id", "asset_id", "line_id", "fault_code", "alarm_text", "priority", "queue", "doc_ref",
          "matched_section", "match_confidence", "score", "status", "needs_human", "sla_breached", "sla_due",
          "assignee", "total_lag_ms", "t_alarm"]


def is_open() -> Column:
    return ~F.col("status").isin(*TERMINAL)


def filters() -> dict[str, Column]:
    return {"attention": F.col("needs_human") & is_open(), "open": is_open(), "breached": F.col("sla_breached")}


def worklist(current: DataFrame, view: str = "attention", limit: int = 200) -> DataFrame:
    """The first ``limit`` incidents of a view, most urgent first; an unknown view lists all."""
    chosen = filters().get(view)
    rows = current.where(chosen) if chosen is not None else current
    return rows.select(*LISTED).orderBy(
        F.col("needs_human").desc_nulls_first(), priority_rank(F.col("priority")),
        F.col("sla_due").asc_nulls_last(), "incident_id").limit(limit)


def view_counts(current: DataFrame) -> DataFrame:
    return current.agg(*[F.count_if(f).alias(name) for name, f in filters().items()], F.count("*").alias("all"))


def waiting(current: DataFrame, limit: int = 20) -> DataFrame:
    """Open incidents that wait for a human."""
    return current.where(filters()["attention"]).orderBy(
        priority_rank(F.col("priority")), F.col("sla_due").asc_nulls_last(), "incident_id").limit(limit).select(
        "incident_id", "asset_id", "fault_code", "priority", "status",
        F.coalesce("doc_ref", F.lit("none")).alias("retrieved"), F.round("score", 3).alias("score"), "sla_due")
