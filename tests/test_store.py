import datetime as dt

import pytest
from faultline.functions import text, triage
from faultline.operators import store
from faultline.operators.audit import audit, audit_summary, calibrate, ground_truth
from faultline.operators.timeline import timelines
from faultline.plans.views import view_counts, worklist
from faultline.schemas import ACTION, CONTEXT, STATUS, WORK_ORDER
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1, 10)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(spark, schema, *dicts):
    return spark.createDataFrame([tuple(d.get(n) for n in schema.names) for d in dicts], schema)


def action(i, incident, what, **more):
    return dict(action_id=i, incident_id=incident, what=what, actor="planner", acted_at=at(1000 + i), **more)


def test_late_context_leaves_other_families_alone(spark):
    ctx = rows(spark, CONTEXT, dict(alarm_id="a", t_alarm=T0, t_context=at(1), priority="P1"))
    act = rows(spark, WORK_ORDER, dict(alarm_id="a", t_action=at(3), ai_work_order="plan"))
    _, hum = store.apply_actions(rows(spark, ACTION, action(1, "a", "assign", assignee=" kim ")))
    late = rows(spark, CONTEXT, dict(alarm_id="a", t_alarm=T0, t_context=at(90), priority="P4"))
    merged = store.merge_incidents(store.context_family(ctx.union(late), F.lit(T0)), store.action_family(act), hum).first()
    assert (merged.priority, merged.ai_work_order, merged.assignee) == ("P1", "plan", "kim")
    assert (merged.retrieval_lag_ms, merged.planning_lag_ms, merged.total_lag_ms) == (1000, 2000, 3000)


def test_families_make_incidents_but_human_rows_do_not(spark):
    ctx = rows(spark, CONTEXT, dict(alarm_id="c", t_context=at(1)))
    act = rows(spark, WORK_ORDER, dict(alarm_id="o", t_action=at(2)))
    log, hum = store.apply_actions(rows(spark, ACTION, action(1, "ghost", "RESOLVED", note="x")))
    merged = store.merge_incidents(store.context_family(ctx, F.lit(T0)), store.action_family(act), hum)
    assert {r.incident_id for r in merged.collect()} == {"c", "o"}
    assert log.first().incident_id == "ghost"
    assert merged.where("incident_id = 'o'").first().total_lag_ms is None


def test_first_and_last_win(spark):
    df = rows(spark, WORK_ORDER, dict(alarm_id="a", t_action=at(5), ai_work_order="late"),
              dict(alarm_id="a", t_action=at(1), ai_work_order="early"),
              dict(alarm_id="a", t_action=None, ai_work_order="untimed"))
    fam = store.action_family(df)
    assert store.first_wins(fam, "incident_id", "t_action").first().ai_work_order == "early"
    assert store.last_wins(fam, "incident_id", "t_action").first().ai_work_order == "late"


def test_human_actions(spark):
    acts = rows(
        spark, ACTION, action(1, "a", "assign", assignee="kim"), action(2, "a", "assign", assignee="  "),
        action(3, "a", "define", manual_action=" swap belt "), action(4, "a", "RESOLVED", note=" done "),
        action(5, "a", "CLOSED", note="   "), action(6, "a", "explode"), action(7, "a", "IN_PROGRESS", note="n"),
        action(8, "a", "define", manual_action=""))
    log, hum = store.apply_actions(acts)
    assert [(r.status, r.note) for r in log.orderBy("seq").collect()] == [
        ("ASSIGNED", "assigned to kim"), ("ACTION_DEFINED", "action written by hand"), ("RESOLVED", "done"),
        ("CLOSED", None), ("IN_PROGRESS", "n")]
    ctx = store.context_family(rows(spark, CONTEXT, dict(alarm_id="a", t_context=at(1))), F.lit(T0))
    act = store.action_family(rows(spark, WORK_ORDER))
    merged = store.merge_incidents(ctx, act, hum).first()
    assert (merged.assignee, merged.manual_action, merged.resolution_notes) == ("kim", "swap belt", None)


def current(spark, statuses, due=at(60), as_of=at(120)):
    ctx = rows(spark, CONTEXT, dict(alarm_id="a", t_context=at(1), sla_due=due))
    incident = store.merge_incidents(store.context_family(ctx, F.lit(T0)), store.action_family(rows(spark, WORK_ORDER)))
    log = rows(spark, STATUS, *[dict(incident_id="a", status=s, actor="p", at_ts=at(t), seq=n)
                                for n, (s, t) in enumerate(statuses)])
    return store.incident_current(incident, log, F.lit(as_of).cast("timestamp_ntz"))


def test_flags_follow_the_last_status(spark):
    seen = current(spark, [("NEEDS_CONTEXT", 1), ("TRIAGED", 1), ("RECEIVED", 0)]).first()
    assert (seen.status, seen.needs_human, seen.sla_breached) == ("TRIAGED", False, True)
    assert current(spark, [("RESOLVED", 2)]).first().sla_breached is False
    assert current(spark, [("NEEDS_REVIEW", 2)]).first().needs_human is True
    assert current(spark, [("TRIAGED", 2)], due=None).first().sla_breached is False
    nothing = current(spark, []).first()
    assert nothing.status is None and nothing.needs_human is None and nothing.sla_breached is None


def test_views(spark):
    state = current(spark, [("NEEDS_REVIEW", 2)])
    assert view_counts(state).first().asDict() == {"attention": 1, "open": 1, "breached": 1, "all": 1}
    assert worklist(state, "attention").count() == worklist(state, "whatever").count() == 1
    assert worklist(current(spark, [("CLOSED", 2)]), "open").count() == 0


def test_timeline_of_one_hot_incident_over_many_buckets(spark):
    log = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("i"), "id")).alias("incident_id"),
        F.lit("S").alias("status"), F.lit("p").alias("actor"), F.lit(None).cast("string").alias("note"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * F.col("id"))).alias("at_ts"),
        F.col("id").alias("seq"))
    got = {r.seq: r.delta_ms for r in timelines(log).where("incident_id = 'hot'").collect()}
    ids = [i for i in range(3000) if i % 3 < 2]
    assert got == {i: None if n == 0 else (i * i - ids[n - 1] ** 2) * 1000 for n, i in enumerate(ids)}
    assert timelines(log).where("incident_id <> 'hot' and delta is not null").count() == 0


def test_delta_labels(spark):
    wanted = {0: "+0 ms", 999: "+999 ms", 1000: "+1.0 s", 1150: "+1.1 s", 1250: "+1.2 s", 59_999: "+60.0 s",
              90_000: "+2 min", 150_000: "+2 min", 3_600_000: "+1.0 h", 86_400_000: "+1.0 d",
              86_400_000 * 2000: "+2000.0 d"}
    df = spark.createDataFrame([(m,) for m in wanted], "ms BIGINT")
    assert {r.ms: r.d for r in df.select("ms", text.delta_label(F.col("ms")).alias("d")).collect()} == wanted


@pytest.mark.parametrize("severity,criticality,priority,hours", [
    (4, "redundant", "P1", 1), (3, "line_critical", "P1", 1), (3, "standby", "P2", 4), (2, "line_critical", "P2", 4),
    (2, None, "P3", 24), (1, "line_critical", "P4", 72), (None, "line_critical", "P4", 72)])
def test_urgency(spark, severity, criticality, priority, hours):
    df = spark.createDataFrame([(severity, criticality, T0)], "s INT, c STRING, t TIMESTAMP_NTZ")
    row = df.select(triage.priority(F.col("s"), F.col("c")).alias("p"),
                    triage.sla_due(F.col("t"), F.col("s"), F.col("c")).alias("d")).first()
    assert (row.p, row.d) == (priority, T0 + dt.timedelta(hours=hours))


def test_null_parts(spark):
    df = spark.createDataFrame([(None, None)], "score DOUBLE, category STRING")
    row = df.select(triage.match_confidence(F.col("score")).alias("m"), triage.queue(F.col("category")).alias("q")).first()
    assert (row.m, row.q) == ("low", "mechanical-team")


def orders(spark, *cases):
    return rows(spark, WORK_ORDER, *[dict(alarm_id=str(i), fault_code=f, doc_ref=d, match_confidence=m, score=s)
                                     for i, (f, d, m, s) in enumerate(cases)])


def test_audit_is_two_sided(spark):
    mapping = spark.createDataFrame([("A", "SM-1"), ("U", None)], "fault_code STRING, expected STRING")
    judged = audit(orders(spark, ("A", "SM-1", "low", 0.5), ("A", "SM-2", "high", 0.6), ("U", "SM-1", "low", 0.1),
                          ("U", "SM-1", "high", 0.7), ("X", "SM-1", "low", 0.2)), mapping)
    assert [r.result for r in judged.orderBy("alarm_id").collect()] == [
        "ok", "MISMATCH", "ok", "SCORED high, WANTED low", "MISMATCH"]
    total = audit_summary(judged).first()
    assert (total.correct, total.total, total.covered, total.uncovered) == (2, 5, 3, 2)


def test_calibration_equals_trying_every_cut(spark):
    scores = [((i * 37) % 101) / 101 for i in range(101)]
    cases = [("U" if (i * 7) % 5 == 0 and s < 0.6 else "A", "SM-1", "low", s) for i, s in enumerate(scores)]
    mapping = spark.createDataFrame([("A", "SM-1"), ("U", None)], "fault_code STRING, expected STRING")
    best = calibrate(audit(orders(spark, *cases), mapping)).first()
    tried = [(sum(f == "U" and s < cut for f, _, _, s in cases), -sum(f == "A" and s < cut for f, _, _, s in cases), -cut)
             for cut in scores]
    caught, flagged, cut = max(tried)
    assert (best.caught, best.flagged) == (caught, -flagged) and best.cut == pytest.approx(-cut, abs=1e-6)


def test_ground_truth_of_the_manual(spark):
    judged = audit(orders(spark, ("VIB-HIGH", "SM-4.3", "high", 0.6), ("FIRE-DOOR", "SM-1.1", "low", 0.4)), ground_truth(spark))
    assert judged.where("correct").count() == 2 and ground_truth(spark).where("expected is null").count() == 5


def test_prompt_with_a_missing_part_is_null(spark):
    df = rows(spark, CONTEXT, dict(alarm_id="a", asset_id="x")).withColumn("section", F.lit("s")).withColumn(
        "content", F.lit("c"))
    assert df.select(text.planner_input().alias("p")).first().p is None


def test_range_before_the_merge_equals_range_after_it(spark):
    ctx = rows(spark, CONTEXT, *[dict(alarm_id=str(i), t_alarm=T0, t_context=at(i)) for i in range(50)],
               *[dict(alarm_id=str(i), t_alarm=T0, t_context=at(i + 25)) for i in range(20)])
    act = store.action_family(rows(spark, WORK_ORDER, *[dict(alarm_id=str(i), t_action=at(2 * i)) for i in range(0, 50, 2)]))
    ctx = store.context_family(ctx, F.col("t_context"))
    since, until = [F.lit(at(s)).cast("timestamp_ntz") for s in (10, 30)]
    for column in ("created_at", "t_action"):
        got = store.incidents_between(ctx, act, None, column, since, until)
        want = store.merge_incidents(ctx, act).where((F.col(column) > since) & (F.col(column) <= until))
        assert want.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
