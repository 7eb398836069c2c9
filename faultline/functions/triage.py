"""Planning fields derived from a retrieved section: all plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: triage rules ---------------------------------------------------------------
HIGH, MEDIUM = 0.55, 0.47
QUEUES = {
    "safety": "safety-officer",
    "electrical": "electrical-team",
    "hydraulic": "fluid-power-team",
    "pneumatic": "fluid-power-team",
    "thermal": "facilities-team",
}
DEFAULT_QUEUE = "mechanical-team"
# (least severity, needs a line-critical asset, priority, hours allowed); the first that fits counts
URGENCY = [
    (4, False, "P1", 1),
    (3, True, "P1", 1),
    (3, False, "P2", 4),
    (2, True, "P2", 4),
    (2, False, "P3", 24),
]
LEAST_URGENT = ("P4", 72)


def match_confidence(score: Column, high: float = HIGH, medium: float = MEDIUM) -> Column:
    """Thresholds belong to the corpus and its embedder, hence parameters. NULL counts as low."""
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def _by_urgency(severity: Column, criticality: Column, pick: int) -> Column:
    chain = F
    for rule in URGENCY:
        least, critical_only, *outcome = rule
        fits = severity >= least
        if critical_only:
            fits = fits & (criticality == "line_critical")
        chain = chain.when(fits, F.lit(outcome[pick]))
    return chain.otherwise(F.lit(LEAST_URGENT[pick]))


def priority(severity: Column, criticality: Column) -> Column:
    return _by_urgency(severity, criticality, 0)


def sla_due(alarm_time: Column, severity: Column, criticality: Column) -> Column:
    hours = _by_urgency(severity, criticality, 1)
    return alarm_time + F.make_dt_interval(hours=hours)


def queue(category: Column) -> Column:
    chain = F
    for name, team in QUEUES.items():
        chain = chain.when(category == name, team)
    return chain.otherwise(DEFAULT_QUEUE)


def shift_of(ts: Column) -> Column:
    hour = F.hour(ts)
    return F.when(hour.between(6, 13), "A").when(hour.between(14, 21), "B").otherwise("C")


def priority_rank(name: Column) -> Column:
    return F.when(name == "P1", 1).when(name == "P2", 2).when(name == "P3", 3).otherwise(4)
