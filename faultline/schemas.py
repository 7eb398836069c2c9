"""Declared schemas, enumerations and thresholds. Nothing is inferred and nothing evolves."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "FLOAT": T.FloatType(), "INT": T.IntegerType(),
    "BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()), "ARRAY<FLOAT>": T.ArrayType(T.FloatType()),
}


def struct(spec: str) -> T.StructType:
    """``name TYPE, name TYPE, ...`` (Spark's own reader of such text needs a running session)."""
    pairs = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


# ---- fixed values: column names and types of the four records -------------------------------
ALARM = struct(
    "alarm_id STRING, asset_id STRING, line_id STRING, fault_code STRING, alarm_text STRING, "
    "vibration_mms DOUBLE, temp_c INT, pressure_bar INT, criticality STRING, shift STRING, "
    "alarm_time TIMESTAMP_NTZ"
)

CONTEXT = struct(
    "alarm_id STRING, asset_id STRING, line_id STRING, fault_code STRING, alarm_text STRING, "
    "vibration_mms DOUBLE, temp_c INT, pressure_bar INT, criticality STRING, shift STRING, "
    "matched_section STRING, doc_ref STRING, category STRING, severity INT, score FLOAT, "
    "match_confidence STRING, priority STRING, queue STRING, sla_due TIMESTAMP_NTZ, "
    "t_alarm TIMESTAMP_NTZ, t_context TIMESTAMP_NTZ, planner_input STRING"
)

WORK_ORDER = struct(
    "alarm_id STRING, asset_id STRING, line_id STRING, fault_code STRING, alarm_text STRING, "
    "matched_section STRING, doc_ref STRING, category STRING, severity INT, score FLOAT, "
    "match_confidence STRING, priority STRING, queue STRING, sla_due TIMESTAMP_NTZ, "
    "t_alarm TIMESTAMP_NTZ, t_context TIMESTAMP_NTZ, t_action TIMESTAMP_NTZ, ai_work_order STRING"
)

MANUAL = struct(
    "id BIGINT, content STRING, category STRING, section STRING, doc_ref STRING, "
    "severity INT, vec ARRAY<FLOAT>"
)

STATUS = struct(
    "incident_id STRING, status STRING, actor STRING, note STRING, at_ts TIMESTAMP_NTZ, seq BIGINT"
)

ACTION = struct(
    "action_id BIGINT, incident_id STRING, what STRING, assignee STRING, manual_action STRING, "
    "note STRING, actor STRING, acted_at TIMESTAMP_NTZ"
)

PLAN_REPLY = struct(
    "diagnosis STRING, action STRING, parts ARRAY<STRING>, safety STRING, "
    "estimated_minutes INT, line_stop_likely BOOLEAN"
)

# ---- fixed values: enumerations --------------------------------------------------------------
CRITICALITIES = ("line_critical", "standby", "redundant")
CATEGORIES = ("mechanical", "hydraulic", "electrical", "thermal", "safety", "pneumatic")
PRIORITIES = ("P1", "P2", "P3", "P4")
TERMINAL = ("RESOLVED", "CLOSED", "REJECTED")
HUMAN_NEEDED = ("NEEDS_CONTEXT", "NEEDS_REVIEW")
METRICS = ("COSINE", "L2", "IP")

# ---- fixed values: contract between the planning prompt and the status log --------------------
GUARD = "insufficient documentation"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# Columns of the two pipeline-owned families; the human family owns the rest.
CONTEXT_FAMILY = tuple(f.name for f in CONTEXT if f.name not in ("alarm_id", "planner_input"))
ACTION_FAMILY = ("ai_work_order", "t_action")
HUMAN_FAMILY = ("assignee", "manual_action", "resolution_notes")
