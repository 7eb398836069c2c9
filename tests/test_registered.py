"""Registered queries against their SQL, at the smallest scale.

FAULTLINE_ALL=1 runs every query; by default one or two of each kind (tools/compare.py runs all at
any scale).
"""

import os

import __spark_entry__ as entry
import compare
import pytest

SOME = """retrieve_enrich src_json_lenient src_topic_batch_replay snk_corpus_overwrite conform_schema
corpus_exclusions rule_lookup_first_match ml_predict work_order_parse vs_lateral_left vs_distinct_probes vs_metric_l2
vs_prefilter vs_blocked vs_ann_index vs_ann_exhaustive status_log upsert_last_wins incident_current timeline_delta format_delta
view_attention dash_p95 dash_latency_series sum_latency audit_summary calibrate_threshold stream_status
stream_human_actions""".split()
NAMES = list(entry.queries()) if os.environ.get("FAULTLINE_ALL") else SOME


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf, con, name):
    verdict, rows, _, detail = compare.compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert verdict in ("equal", "rows only"), detail
    assert rows > 0 or name == "incident_lookup"


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.oracle_sql()) - set(entry.LLM_QUERIES) == {"vs_ann_recall"}


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["retrieve_enrich", "vs_blocked", "incident_current", "audit_rows", "timeline_delta",
                                  "corpus_exclusions", "calibrate_threshold", "dash_time_split"])
def test_plan_has_no_pairwise_join(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_search_reads_only_what_it_needs(spark, sf):
    plan = entry.queries()["match_confidence"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("text:string" in line for line in scans)
