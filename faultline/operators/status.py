"""The append-only status log: which rows each stage contributes.

``seq`` stands for insertion order among rows of one instant: 1-4 for the stages in causal order,
human actions after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import retrieval_note, ungrounded
from faultline.schemas import STATUS

HUMAN_SEQ = 10


def _row(status: Column, note: Column, at: Column, seq: int) -> Column:
    return F.struct(status.alias("status"), F.lit("pipeline").alias("actor"),
                    note.cast("string").alias("note"), at.alias("at_ts"), F.lit(seq).cast("bigint").alias("seq"))


def _log(df: DataFrame, *rows: Column) -> DataFrame:
    """One pass over ``df`` emitting all of its status rows."""
    return df.select(F.col("alarm_id").alias("incident_id"), F.inline(F.array(*rows))).select(*STATUS.names)


def _received() -> Column:
    return _row(F.lit("RECEIVED"), F.lit(None), F.col("alarm_time"), 1)


def _failure(records: DataFrame) -> Column:
    """The reason of a failed model call, where the records carry one."""
    return F.col("error") if "error" in records.columns else F.lit(None).cast("string")


def _contextualized(failure: Column) -> Column:
    low = (F.col("match_confidence") == "low") | failure.isNotNull()
    note = F.coalesce(failure, retrieval_note(F.col("doc_ref"), F.col("score")))
    return _row(F.when(low, "NEEDS_CONTEXT").otherwise("CONTEXTUALIZED"), note, F.col("t_context"), 2)


def _triaged() -> Column:
    # one millisecond later, so that triage always sorts after the retrieval it depends on
    at = F.col("t_context") + F.expr("INTERVAL '0.001' SECOND")
    return _row(F.lit("TRIAGED"), F.concat("priority", F.lit(" to "), "queue"), at, 3)


def _planned(failure: Column) -> Column:
    refused = ungrounded(F.col("ai_work_order"))
    name = F.when(refused | failure.isNotNull(), "NEEDS_REVIEW").otherwise("ACTION_DEFINED")
    note = F.coalesce(failure, F.when(refused, "planner could not ground an action"))
    return _row(name, note, F.col("t_action"), 4)


def status_received(alarms: DataFrame) -> DataFrame:
    return _log(alarms, _received())


def status_context(ctx: DataFrame) -> DataFrame:
    return _log(ctx, _contextualized(_failure(ctx)))


def status_triaged(ctx: DataFrame) -> DataFrame:
    return _log(ctx, _triaged())


def status_retrieved(ctx: DataFrame) -> DataFrame:
    """Both rows of stage 1 from one read of its output."""
    return _log(ctx, _contextualized(_failure(ctx)), _triaged())


def status_action(orders: DataFrame) -> DataFrame:
    return _log(orders, _planned(_failure(orders)))


def status_log(alarms: DataFrame, ctx: DataFrame, orders: DataFrame) -> DataFrame:
    return status_received(alarms).unionByName(status_retrieved(ctx)).unionByName(status_action(orders))


def ranked(row: Column | None = None) -> Column:
    """Comparable status row: by time, then insertion order. Without ``row`` the columns of a log."""
    names = ("at_ts", "seq", "status")
    return F.struct(*[(F.col(c) if row is None else row[c]).alias(c) for c in names])


def last_of_record() -> Column:
    """The last of the rows that ``status_log`` has for the context and the order of one alarm."""
    failure = F.lit(None).cast("string")
    return F.greatest(*[ranked(row) for row in (_contextualized(failure), _triaged(), _planned(failure))])
