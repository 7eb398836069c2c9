"""Text columns: the planning prompt, notes, labels, and the parsed reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.schemas import GUARD, PLAN_REPLY


def planner_input() -> Column:
    """The prompt, from the columns of an enriched hit; any NULL part makes it NULL."""
    c = F.col
    # fixed values: wording of the prompt
    parts = [
        "ALARM on ", c("asset_id"), ". ",
        "Report: ", c("alarm_text"), " ",
        "Readings: vibration ", c("vibration_mms").cast("string"), " mm/s RMS, ",
        "temperature ", c("temp_c").cast("string"), " C, ",
        "air/hydraulic pressure ", c("pressure_bar").cast("string"), " bar. ",
        "Asset role: ", c("criticality"), ". ",
        "Shift: ", c("shift"), ". ",
        "MANUAL SECTION ", c("doc_ref"), ' "', c("section"), '": ', c("content"),
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def ungrounded(reply: Column) -> Column:
    """The model said it could not ground an action. Case-sensitive; NULL stays NULL."""
    return reply.contains(GUARD)


def work_order(reply: Column) -> Column:
    """The reply as a struct; text that is no JSON object gives NULL, so keep the raw text."""
    parsed = F.from_json(reply, PLAN_REPLY, {"mode": "PERMISSIVE"})
    body = F.trim(reply)
    return F.when(body.startswith("{") & F.json_object_keys(body).isNotNull(), parsed)


def retrieval_note(doc_ref: Column, score: Column) -> Column:
    shown = F.round(score.cast("double"), 3).cast("string")
    return F.concat(F.coalesce(doc_ref, F.lit("no match")), F.lit(" at "), shown)


def truncated(text: Column, width: int = 74) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def delta_label(ms: Column) -> Column:
    """Gap in the unit that reads naturally; each limit is exclusive.

    ``format_number`` rounds the exact binary value, ties to even, as C's printf does;
    ``format_string`` would round the decimal text instead.
    """
    # fixed values: upper limit in ms, divisor, digits, unit
    units = [
        (1_000, 1.0, "0", "ms"),
        (60_000, 1_000.0, "0.0", "s"),
        (3_600_000, 60_000.0, "0", "min"),
        (86_400_000, 3_600_000.0, "0.0", "h"),
        (None, 86_400_000.0, "0.0", "d"),
    ]

    def label(divisor, digits, unit):
        number = F.call_function("format_number", ms / F.lit(divisor), F.lit(digits))
        return F.concat(F.lit("+"), number, F.lit(f" {unit}"))
    chain = F
    for limit, *rest in units[:-1]:
        chain = chain.when(ms < limit, label(*rest))
    return F.when(ms.isNotNull(), chain.otherwise(label(*units[-1][1:])))
