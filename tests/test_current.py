"""The current state from records of both stages side by side, against the merge of families and the whole log."""

import datetime as dt

import __spark_entry__ as entry
import numpy as np
import pytest
from faultline.operators import status, store, topk
from faultline.operators.vector_search import TILE_BYTES, smallest_of_equal
from faultline.plans import retrieve
from faultline.schemas import ACTION, ALARM, CONTEXT
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1, 10)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(spark, schema, *dicts):
    return spark.createDataFrame([tuple(d.get(n) for n in schema.names) for d in dicts], schema)


def tables(spark):
    """Two records of one alarm, equal ones, ones without id, time, score or section, and actions of every kind."""
    given = dict(asset_id="x", queue="q", severity=2, doc_ref="SM-1", sla_due=at(5))
    ctx = rows(
        spark, CONTEXT,
        *[dict(given, alarm_id="1", t_alarm=T0, t_context=at(n), match_confidence=m, score=0.5, priority=p)
          for n, m, p in [(9, "low", "P4"), (2, "high", "P1"), (2, "high", "P2"), (2, "high", "P1")]],
        dict(given, alarm_id="2", t_alarm=T0, t_context=at(7200), match_confidence="low", priority="P1"),
        dict(given, alarm_id="3", t_alarm=at(86400), t_context=at(86401), match_confidence="high", priority="P3"),
        dict(given, alarm_id="4", t_alarm=None, t_context=None, match_confidence=None),
        dict(given, alarm_id="5", t_alarm=T0, t_context=None, match_confidence="low", doc_ref=None),
        dict(given, alarm_id=None, t_alarm=T0, t_context=at(1), match_confidence="low"),
        dict(given, alarm_id=None, t_alarm=T0, t_context=at(1), match_confidence="high"))
    alarms = rows(spark, ALARM, *[dict(alarm_id=i, alarm_time=t) for i, t in [
        ("1", T0), ("1", at(1)), ("2", at(9000)), ("3", None), ("only", T0), (None, at(99999))]])
    whats = ["assign", "define", "IN_PROGRESS", "RESOLVED", "REJECTED", "CLOSED", "escalate", None]
    acts = rows(spark, ACTION, *[
        dict(action_id=n, incident_id=i, what=w, acted_at=t, actor="a", assignee=x, manual_action=x, note=x)
        for n, (w, i, t, x) in enumerate(
            (w, i, t, x) for w in whats for i in ("1", "3", "ghost", None) for t in (at(50), None) for x in (" k ", "  ", None))
        if (n + len(str(i))) % 3])
    return ctx, alarms, acts


def test_equals_the_merge_and_the_log(spark):
    ctx, alarms, acts = tables(spark)
    as_of = F.lit(at(4000)).cast("timestamp_ntz")
    arrived = F.col("t_action") <= as_of
    log, hum = store.apply_actions(acts)
    orders = retrieve.work_orders(ctx)
    incident = store.merge_incidents(
        store.context_family(ctx, F.col("t_context")), store.action_family(orders.where(arrived)), hum)
    want = store.incident_current(
        incident, status.status_log(alarms, ctx, orders).unionByName(log), as_of)
    got = store.current_of_records(retrieve.planned(ctx), alarms, acts, as_of, F.col("t_context"), arrived)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    found = {r.incident_id: r for r in got.collect()}
    assert set(found) == {"1", "2", "3", "4", "5", None}  # neither an alarm nor an action alone is an incident
    assert found[None].status is None and found[None].needs_human is None
    assert (found["2"].status, found["1"].priority) == ("RECEIVED", "P1")


@pytest.mark.parametrize("name", ["dash_needs_human", "dash_waiting", "view_open"])
def test_incidents_move_once(spark, sf, name):
    """Families and log meet in one aggregation."""
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Aggregate [incident_id") for line in plan.splitlines()) == 1


def test_distinct_vectors_are_sorted_by_hash(spark):
    """Of equal vectors the k smallest ids, zeros of both signs being equal; whole vectors are compared last."""
    nan = float("nan")
    given = [(n, v) for n, v in enumerate([[1.0, 0.0], [1.0, -0.0], [1.0, 0.0], [nan, 1.0], [nan, 1.0], [nan, 1.0], [2.0],
                                           [1.0, None], [1.0, None], [1.0, None], []])]
    kept = smallest_of_equal(spark.createDataFrame(given, "id BIGINT, cv ARRAY<FLOAT>"), 2)
    assert kept.columns == ["id", "cv"]
    assert sorted(r.id for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8, 10]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [__hash" in line for line in sorts)


def test_score_matrix_holds_enough_probes(monkeypatch):
    """A tile of the largest size is met by enough probes at once for the product to be fast."""
    rng = np.random.default_rng(0)
    tile = topk.pack(np.arange(2000), rng.normal(size=(2000, 8)).astype(np.float32), "COSINE", 3)
    probes = rng.normal(size=(300, 8)).astype(np.float32)
    want = topk.search(tile, probes, "COSINE", 3)
    monkeypatch.setattr(topk, "CELLS_AT_ONCE", 4000)
    for a, b in zip(topk.search(tile, probes, "COSINE", 3), want, strict=True):
        assert (a == b).all()
    monkeypatch.undo()
    assert topk.CELLS_AT_ONCE // (TILE_BYTES // (4 * 64)) >= 60
