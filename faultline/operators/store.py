"""The incident store: append-only column families merged into one row per incident.

Each family is owned by one writer and no writer can touch another's columns. All merging is
aggregation of min/max structs, so repeats of one key collapse before the shuffle, and the families
meet in a single shuffle on ``incident_id`` instead of a chain of outer joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.clock import millis_between
from faultline.operators.status import HUMAN_SEQ, last_of_record, ranked, status_received
from faultline.schemas import ACTION_FAMILY, CONTEXT_FAMILY, HUMAN_FAMILY, HUMAN_NEEDED, STATUS, TERMINAL


def _context_columns(created_at: Column | None = None) -> list[Column]:
    cols = [F.col(c).cast("double").alias(c) if c == "score" else F.col(c) for c in CONTEXT_FAMILY]
    stamp = created_at if created_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return [*cols, stamp.alias("created_at")]


def context_family(ctx: DataFrame, created_at: Column | None = None) -> DataFrame:
    """21 columns of stage 1 keyed by incident, plus the ingest stamp."""
    return ctx.select(F.col("alarm_id").alias("incident_id"), *_context_columns(created_at))


def action_family(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("alarm_id").alias("incident_id"), *ACTION_FAMILY)


def _ordered(time: str, columns: list[str]) -> Column:
    """Comparable record: rows without a time last, then by time, then by content."""
    return F.struct(F.col(time).isNull().alias("late"), F.col(time).alias("__time"), *columns)


def first_wins(family: DataFrame, key: str, time: str) -> DataFrame:
    """Per key the row with the earliest ``time``; map-side combined."""
    rest = [c for c in family.columns if c != key]
    kept = family.groupBy(key).agg(F.min(_ordered(time, rest)).alias("r"))
    return kept.select(key, *[F.col("r")[c].alias(c) for c in rest])


def last_wins(family: DataFrame, key: str, time: str) -> DataFrame:
    """Per key the row with the latest ``time``."""
    rest = [c for c in family.columns if c != key]
    record = F.struct(F.col(time).alias("__time"), *rest)
    kept = family.groupBy(key).agg(F.max(record).alias("r"))
    return kept.select(key, *[F.col("r")[c].alias(c) for c in rest])


def merge_incidents(ctx: DataFrame, act: DataFrame, hum: DataFrame | None = None) -> DataFrame:
    """One row per incident that stage 1 or stage 2 wrote.

    Within the context family the first row counts. A plan written again replaces the earlier one.
    Human columns: the last value written for each, a NULL included. A human row alone creates no
    incident, as an update of a missing row does nothing.
    """
    ctx_cols = [c for c in ctx.columns if c != "incident_id"]
    act_cols = [c for c in act.columns if c != "incident_id"]
    parts = [ctx.select("incident_id", _ordered("t_context", ctx_cols).alias("ctx")),
             act.select("incident_id", _timed("t_action", act_cols).alias("act"))]
    if hum is not None:
        parts.append(hum.select("incident_id", *_human()))
    return with_lags(_columns(_merged(parts), ctx_cols, act_cols))


def _timed(time: str, columns: list[str]) -> Column:
    return F.struct(F.col(time).alias("__time"), *columns)


def _human() -> list[Column]:
    return [_if_set(c).alias(f"hum_{c}") for c in HUMAN_FAMILY]


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Rows of ``incident_id`` and any of ``ctx``, ``act``, ``hum_...`` and ``last`` -> one row per incident that stage 1 or
    stage 2 wrote: of ``ctx`` the least record, of the others the largest."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    picks = [(F.min if c == "ctx" else F.max)(c).alias(c) for c in rows.columns if c != "incident_id"]
    return rows.groupBy("incident_id").agg(*picks).where(F.col("ctx").isNotNull() | F.col("act").isNotNull())


def _columns(merged: DataFrame, ctx_cols: list[str], act_cols: list[str], more: tuple[Column, ...] = ()) -> DataFrame:
    human = [(F.col(f"hum_{c}.value") if f"hum_{c}" in merged.columns else F.lit(None).cast("string")).alias(c)
             for c in HUMAN_FAMILY]
    return merged.select(
        "incident_id", *[F.col("ctx")[c].alias(c) for c in ctx_cols],
        *[F.col("act")[c].alias(c) for c in act_cols], *human, *more)


def incidents_between(ctx: DataFrame, act: DataFrame, hum: DataFrame | None, column: str,
                      since: Column, until: Column) -> DataFrame:
    """Incidents whose ``column`` (``created_at`` or ``t_action``) lies in (since, until].

    The range first selects the keys with any row in it, a filter that reaches the scan of one family;
    only their rows are merged, and the merged value decides. The whole store is not shuffled for an
    hour of it.
    """
    def inside(df):
        return df.where((F.col(column) > since) & (F.col(column) <= until))
    keys = inside(ctx if column in ctx.columns else act).select("incident_id").distinct()
    parts = [df.join(keys, "incident_id", "left_semi") if df is not None else None for df in (ctx, act, hum)]
    return inside(merge_incidents(*parts))


def _if_set(column: str) -> Column:
    record = F.struct("acted_at", "action_id", F.col(column).alias("value"))
    return F.when(F.col("sets") == column, record)


def with_lags(incident: DataFrame) -> DataFrame:
    c = F.col
    return (incident
            .withColumn("retrieval_lag_ms", millis_between(c("t_alarm"), c("t_context")))
            .withColumn("planning_lag_ms", millis_between(c("t_context"), c("t_action")))
            .withColumn("total_lag_ms", millis_between(c("t_alarm"), c("t_action"))))


def _effective(actions: DataFrame) -> DataFrame:
    """The actions that have an effect, with their status row and what they set (NULL: no human column)."""
    def text(name):
        trimmed = F.trim(F.col(name))
        return F.when(trimmed != "", trimmed)

    what, note = F.col("what"), text("note")
    assigned = (what == "assign") & text("assignee").isNotNull()
    defined = (what == "define") & text("manual_action").isNotNull()
    moved = what.isin("IN_PROGRESS", "REJECTED")
    ended = what.isin("RESOLVED", "CLOSED")
    status = (F.when(assigned, "ASSIGNED").when(defined, "ACTION_DEFINED").when(moved | ended, what))
    return actions.withColumn("status", status).where(F.col("status").isNotNull()).select(
        "incident_id", "action_id", "acted_at", "status", "actor",
        F.when(assigned, F.concat(F.lit("assigned to "), text("assignee")))
        .when(defined, "action written by hand").otherwise(note).alias("note"),
        F.col("acted_at").alias("at_ts"), (F.col("action_id") + HUMAN_SEQ).alias("seq"),
        F.when(assigned, "assignee").when(defined, "manual_action").when(ended, "resolution_notes").alias("sets"),
        F.when(assigned, text("assignee")).alias("assignee"),
        F.when(defined, text("manual_action")).alias("manual_action"),
        F.when(ended, note).alias("resolution_notes"))


def apply_actions(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Human actions -> (status rows, human family rows), both from the one action record.

    An unknown action, or an assignment or definition without text, has no effect at all.
    """
    effective = _effective(actions)
    family = effective.where(F.col("sets").isNotNull()).select(
        "incident_id", "action_id", "acted_at", "sets", *HUMAN_FAMILY)
    return effective.select(*STATUS.names), family


def latest_status(log: DataFrame) -> DataFrame:
    """Per incident the last row by (at_ts, seq), combined before the shuffle."""
    last = F.max(ranked()).alias("s")
    return log.groupBy("incident_id").agg(last).select(
        "incident_id", F.col("s.status").alias("status"), F.col("s.at_ts").alias("status_at"))


def incident_current(incident: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Current state, derived from the log."""
    return with_flags(incident.join(latest_status(log), "incident_id", "left"), as_of)


def current_of_records(planned: DataFrame, alarms: DataFrame, actions: DataFrame, as_of: Column,
                       created_at: Column, arrived: Column) -> DataFrame:
    """``incident_current`` of ``merge_incidents`` and the whole log, where stages 1 and 2 left one record each for an alarm
    and ``planned`` holds both side by side (no model call failed: no ``error``).

    What comes from one record travels in one row: its context, its order if ``arrived``, and the last of its status rows;
    a human action likewise. Families and log so meet in one aggregation, with a third of the rows and no join.
    """
    records = planned.select(
        F.col("alarm_id").alias("incident_id"), *_context_columns(created_at),
        F.when(arrived, _timed("t_action", list(ACTION_FAMILY))).alias("act"), last_of_record().alias("last"))
    ctx_cols = [c for c in records.columns if c not in ("incident_id", "act", "last")]
    merged = _merged([
        records.select("incident_id", _ordered("t_context", ctx_cols).alias("ctx"), "act", "last"),
        status_received(alarms).select("incident_id", ranked().alias("last")),
        _effective(actions).select("incident_id", *_human(), ranked().alias("last"))])
    last = F.when(F.col("incident_id").isNotNull(), F.col("last"))  # a NULL id has no log of its own
    incident = with_lags(_columns(merged, ctx_cols, list(ACTION_FAMILY), (last.alias("last"),)))
    return with_flags(incident.withColumns({
        "status": F.col("last.status"), "status_at": F.col("last.at_ts")}).drop("last"), as_of)


def with_flags(current: DataFrame, as_of: Column) -> DataFrame:
    """NULL status: NULL flags, except where SLA is undated."""
    status = F.col("status")
    return current.withColumn("needs_human", status.isin(*HUMAN_NEEDED)).withColumn(
        "sla_breached",
        F.col("sla_due").isNotNull() & (as_of > F.col("sla_due")) & ~status.isin(*TERMINAL))


def ever_needed_human(log: DataFrame) -> DataFrame:
    """Whether any row of the log asked for a human; the current flag only sees the last row."""
    return log.groupBy("incident_id").agg(
        F.coalesce(F.bool_or(F.col("status").isin(*HUMAN_NEEDED)), F.lit(False)).alias("ever_needed_human"))


def incident_lookup(current: DataFrame, incident_id: str) -> DataFrame:
    return current.where(F.col("incident_id") == incident_id)
