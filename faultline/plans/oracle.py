"""The registered queries once more, as SQL over the same tables, written independently of the plans."""

from __future__ import annotations

import re

from faultline.schemas import CONTEXT_FAMILY, TERMINAL
from faultline.plans.catalog import AS_OF, REPLAYED

ORACLES: dict[str, str] = {}
NOW = f"TIMESTAMP '{AS_OF}'"
ENDED = "(" + ", ".join(f"'{s}'" for s in TERMINAL) + ")"

# ---- shared inputs ----------------------------------------------------------------------------

ALARMS = """alarms AS (
  SELECT CAST(event_id AS VARCHAR) AS alarm_id, event_id AS eid,
    CASE user_id % 6 WHEN 0 THEN 'PRESS-04' WHEN 1 THEN 'MILL-11' WHEN 2 THEN 'LATHE-02'
      WHEN 3 THEN 'CNC-07' WHEN 4 THEN 'WELD-03' ELSE 'CONV-01' END AS asset_id,
    CASE WHEN user_id % 6 < 2 THEN 'LINE-A' WHEN user_id % 6 < 4 THEN 'LINE-B' ELSE 'LINE-C' END AS line_id,
    upper(event_type) AS fault_code,
    'report of ' || event_type || ' by unit ' || CAST(user_id AS VARCHAR) AS alarm_text,
    value AS vibration_mms, CAST(34 + event_id % 60 AS INTEGER) AS temp_c,
    CAST(96 + event_id % 80 AS INTEGER) AS pressure_bar,
    CASE WHEN event_id % 10 < 5 THEN 'line_critical' WHEN event_id % 10 < 8 THEN 'standby'
      ELSE 'redundant' END AS criticality,
    CASE WHEN hour(ts) BETWEEN 6 AND 13 THEN 'A' WHEN hour(ts) BETWEEN 14 AND 21 THEN 'B' ELSE 'C' END AS shift,
    CAST(date_trunc('millisecond', ts) AS TIMESTAMP) AS alarm_time,
    CASE WHEN event_id % 50 <> 49 THEN event_id % (SELECT count(*) FROM embeddings) END AS probe_id
  FROM events)"""

PROBES = "probes AS (SELECT vec_id AS probe_id, CAST(list_reverse(embedding) AS DOUBLE[]) AS pv FROM embeddings)"


def manual(stretched: bool = False) -> str:
    vec = "embedding"
    if stretched:
        vec = "list_transform(embedding, lambda x: CAST(x * (1 + doc_id % 3) AS FLOAT))"
    return f"""manual AS (
  SELECT doc_id AS id, text AS content,
    CASE label % 6 WHEN 0 THEN 'mechanical' WHEN 1 THEN 'hydraulic' WHEN 2 THEN 'electrical'
      WHEN 3 THEN 'thermal' WHEN 4 THEN 'safety' ELSE 'pneumatic' END AS category,
    'Section ' || CAST(doc_id AS VARCHAR) AS section, 'SM-' || CAST(doc_id AS VARCHAR) AS doc_ref,
    CASE WHEN doc_id % 10 < 3 THEN 1 WHEN doc_id % 10 < 7 THEN 2 WHEN doc_id % 10 < 9 THEN 3 ELSE 4 END AS severity,
    {vec} AS vec
  FROM documents JOIN embeddings ON vec_id = doc_id % (SELECT count(*) FROM embeddings))"""


METRIC_SQL = {"COSINE": ("list_cosine_similarity", "DESC"), "IP": ("list_inner_product", "DESC"),
              "L2": ("list_distance", "ASC")}


def hits(k: int = 1, metric: str = "COSINE", where: str = "TRUE") -> str:
    function, direction = METRIC_SQL[metric]
    return f"""scored AS (
  SELECT probe_id, id, {function}(pv, CAST(vec AS DOUBLE[])) AS score
  FROM probes CROSS JOIN (SELECT id, vec FROM manual WHERE {where})),
hits AS (
  SELECT probe_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY score {direction}, id) AS rank FROM scored)
  WHERE rank <= {k})"""


CONTEXT_SQL = """context AS (
  SELECT a.alarm_id, eid, asset_id, line_id, fault_code, alarm_text, vibration_mms, temp_c, pressure_bar,
    criticality, shift, section AS matched_section, doc_ref, category, severity, CAST(score AS FLOAT) AS score,
    CASE WHEN score >= 0.40 THEN 'high' WHEN score >= 0.34 THEN 'medium' ELSE 'low' END AS match_confidence,
    CASE WHEN severity >= 4 OR (severity = 3 AND criticality = 'line_critical') THEN 'P1'
      WHEN severity = 3 OR (severity = 2 AND criticality = 'line_critical') THEN 'P2'
      WHEN severity = 2 THEN 'P3' ELSE 'P4' END AS priority,
    CASE WHEN category = 'safety' THEN 'safety-officer' WHEN category = 'electrical' THEN 'electrical-team'
      WHEN category IN ('hydraulic', 'pneumatic') THEN 'fluid-power-team'
      WHEN category = 'thermal' THEN 'facilities-team' ELSE 'mechanical-team' END AS queue,
    alarm_time + CASE WHEN severity >= 4 OR (severity = 3 AND criticality = 'line_critical') THEN INTERVAL 1 HOUR
      WHEN severity = 3 OR (severity = 2 AND criticality = 'line_critical') THEN INTERVAL 4 HOUR
      WHEN severity = 2 THEN INTERVAL 24 HOUR ELSE INTERVAL 72 HOUR END AS sla_due,
    alarm_time AS t_alarm, alarm_time + (300 + eid % 700) * INTERVAL 1 MILLISECOND AS t_context,
    'ALARM on ' || asset_id || '. Report: ' || alarm_text || ' Readings: vibration '
      || CAST(vibration_mms AS VARCHAR) || ' mm/s RMS, temperature ' || CAST(temp_c AS VARCHAR)
      || ' C, air/hydraulic pressure ' || CAST(pressure_bar AS VARCHAR) || ' bar. Asset role: ' || criticality
      || '. Shift: ' || shift || '. MANUAL SECTION ' || doc_ref || ' "' || section || '": ' || content
      AS planner_input
  FROM alarms a JOIN hits h ON a.probe_id = h.probe_id JOIN manual m ON m.id = h.id)"""

ORDERS_SQL = """orders AS (
  SELECT *, t_alarm + (1300 + eid % 700 + eid % 1500) * INTERVAL 1 MILLISECOND AS t_action,
    CASE WHEN match_confidence = 'low' THEN '{"diagnosis":"insufficient documentation","action":"none","parts":[],'
        || '"safety":"none","estimated_minutes":0,"line_stop_likely":false}'
      ELSE '{"diagnosis":"see ' || doc_ref || '","action":"send ' || queue || '","parts":[],"safety":"none",'
        || '"estimated_minutes":' || CAST(severity * 15 AS VARCHAR) || ',"line_stop_likely":'
        || CASE WHEN severity >= 4 THEN 'true' ELSE 'false' END || '}' END AS ai_work_order
  FROM context)"""

PIPELINE_LOG_SQL = """pipeline_log AS (
  SELECT alarm_id AS incident_id, 'RECEIVED' AS status, 'pipeline' AS actor, CAST(NULL AS VARCHAR) AS note,
    alarm_time AS at_ts, 1::BIGINT AS seq FROM alarms
  UNION ALL SELECT alarm_id, CASE WHEN match_confidence = 'low' THEN 'NEEDS_CONTEXT' ELSE 'CONTEXTUALIZED' END,
    'pipeline', doc_ref || ' at ' || CAST(round(CAST(score AS DOUBLE), 3) AS VARCHAR), t_context, 2 FROM context
  UNION ALL SELECT alarm_id, 'TRIAGED', 'pipeline', priority || ' to ' || queue,
    t_context + INTERVAL 1 MILLISECOND, 3 FROM context
  UNION ALL SELECT alarm_id,
    CASE WHEN contains(ai_work_order, 'insufficient documentation') THEN 'NEEDS_REVIEW' ELSE 'ACTION_DEFINED' END,
    'pipeline', CASE WHEN contains(ai_work_order, 'insufficient documentation')
      THEN 'planner could not ground an action' END, t_action, 4 FROM orders)"""

ACTIONS_SQL = """actions AS (
  SELECT event_id AS action_id, CAST(event_id - event_id % 4 AS VARCHAR) AS incident_id,
    CASE event_id % 7 WHEN 0 THEN 'assign' WHEN 1 THEN 'define' WHEN 2 THEN 'IN_PROGRESS' WHEN 3 THEN 'RESOLVED'
      WHEN 4 THEN 'REJECTED' WHEN 5 THEN 'CLOSED' ELSE 'escalate' END AS what,
    CASE WHEN user_id % 5 <> 0 THEN 'tech-' || CAST(user_id AS VARCHAR) END AS who,
    CASE WHEN user_id % 4 <> 0 THEN 'replace unit ' || CAST(user_id AS VARCHAR) END AS deed,
    CASE WHEN user_id % 3 <> 0 THEN 'note by ' || CAST(user_id AS VARCHAR) END AS remark,
    CAST(date_trunc('millisecond', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS acted_at
  FROM events),
done AS (
  SELECT * FROM actions WHERE what <> 'escalate' AND NOT (what = 'assign' AND who IS NULL)
    AND NOT (what = 'define' AND deed IS NULL)),
human_log AS (
  SELECT incident_id,
    CASE what WHEN 'assign' THEN 'ASSIGNED' WHEN 'define' THEN 'ACTION_DEFINED' ELSE what END AS status,
    'planner' AS actor,
    CASE what WHEN 'assign' THEN 'assigned to ' || who WHEN 'define' THEN 'action written by hand'
      ELSE remark END AS note,
    acted_at AS at_ts, action_id + 10 AS seq FROM done)"""

LOG_SQL = """log AS (SELECT * FROM pipeline_log UNION ALL SELECT * FROM human_log)"""

INCIDENT_COLUMNS = ", ".join(
    "round(CAST(c.score AS DOUBLE), 6) AS score" if c == "score" else f"c.{c}" for c in CONTEXT_FAMILY)

INCIDENT_SQL = f"""last_assign AS (
  SELECT incident_id, who AS assignee FROM done WHERE what = 'assign'
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY acted_at DESC, action_id DESC) = 1),
last_define AS (
  SELECT incident_id, deed AS manual_action FROM done WHERE what = 'define'
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY acted_at DESC, action_id DESC) = 1),
last_end AS (
  SELECT incident_id, remark AS resolution_notes FROM done WHERE what IN ('RESOLVED', 'CLOSED')
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY acted_at DESC, action_id DESC) = 1),
incident AS (
  SELECT c.alarm_id AS incident_id, c.eid, {INCIDENT_COLUMNS}, CAST(c.score AS DOUBLE) AS full_score,
    c.t_context AS created_at, o.ai_work_order, o.t_action, assignee, manual_action, resolution_notes,
    date_diff('millisecond', c.t_alarm, c.t_context) AS retrieval_lag_ms,
    date_diff('millisecond', c.t_context, o.t_action) AS planning_lag_ms,
    date_diff('millisecond', c.t_alarm, o.t_action) AS total_lag_ms
  FROM context c LEFT JOIN (SELECT * FROM orders WHERE t_action <= {NOW}) o ON o.alarm_id = c.alarm_id
    LEFT JOIN last_assign la ON la.incident_id = c.alarm_id
    LEFT JOIN last_define ld ON ld.incident_id = c.alarm_id
    LEFT JOIN last_end le ON le.incident_id = c.alarm_id)"""

LATEST_SQL = """latest AS (
  SELECT incident_id, status, at_ts AS status_at FROM log
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY at_ts DESC, seq DESC) = 1)"""

CURRENT_SQL = f"""current AS (
  SELECT i.*, s.status, s.status_at, s.status IN ('NEEDS_CONTEXT', 'NEEDS_REVIEW') AS needs_human,
    (i.sla_due IS NOT NULL AND {NOW} > i.sla_due AND s.status NOT IN {ENDED}) AS sla_breached
  FROM incident i LEFT JOIN latest s ON s.incident_id = i.incident_id)"""


def with_(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


TO_HITS = [ALARMS, PROBES, manual(), hits()]
TO_CONTEXT = [*TO_HITS, CONTEXT_SQL]
TO_ORDERS = [*TO_CONTEXT, ORDERS_SQL]
TO_INCIDENT = [*TO_ORDERS, ACTIONS_SQL, INCIDENT_SQL]
TO_LOG = [*TO_ORDERS, PIPELINE_LOG_SQL, ACTIONS_SQL, LOG_SQL]
TO_CURRENT = [*TO_LOG, INCIDENT_SQL, LATEST_SQL, CURRENT_SQL]


def add(name: str, select: str, ctes: list[str] = ()) -> None:
    ORACLES[name] = with_(select, *ctes) if ctes else select


SCORE = "round(CAST(score AS DOUBLE), 6) AS score"
CONTEXT_LIST = f"""alarm_id, asset_id, line_id, fault_code, alarm_text, vibration_mms, temp_c, pressure_bar,
  criticality, shift, matched_section, doc_ref, category, severity, {SCORE}, match_confidence, priority, queue,
  sla_due, t_alarm, t_context, md5(planner_input) AS planner_input"""

add("retrieve_enrich", f"SELECT {CONTEXT_LIST} FROM context", TO_CONTEXT)
add("stream_context", f"SELECT {CONTEXT_LIST} FROM context", TO_CONTEXT)

# ---- sources and sinks ------------------------------------------------------------------------

add("src_json_lenient", """
SELECT alarm_id, fault_code, CASE WHEN eid % 11 <> 4 THEN temp_c END AS temp_c, CAST(NULL AS VARCHAR) AS alarm_text,
  CASE WHEN eid % 13 <> 3 THEN alarm_time END AS alarm_time
FROM alarms WHERE eid % 7 <> 2""", [ALARMS])
add("src_topic_batch_replay",
    "SELECT " + ", ".join(SCORE if c == "score" else c for c in REPLAYED) + " FROM orders", TO_ORDERS)
add("src_corpus_table", """
SELECT id, md5(content) AS content, category, section, doc_ref, severity, CAST(len(vec) AS INTEGER) AS dim
FROM manual""", [manual()])
add("snk_keyed_by_asset", """
SELECT asset_id AS key, alarm_id, strftime(t_action, '%Y-%m-%d %H:%M:%S.%g') AS t_action FROM orders""", TO_ORDERS)
add("snk_incident_context", """
SELECT alarm_id AS incident_id, """ + ", ".join(SCORE if c == "score" else c for c in CONTEXT_FAMILY)
    + ", t_context AS created_at FROM context", TO_CONTEXT)
add("snk_incident_action", "SELECT alarm_id AS incident_id, ai_work_order, t_action FROM orders", TO_ORDERS)
add("snk_corpus_overwrite", """
SELECT source, doc_id, md5(text) AS content, row_number() OVER (ORDER BY source, doc_id) - 1 AS id FROM documents""")

# ---- corpus -----------------------------------------------------------------------------------

add("conform_schema", """
SELECT p_partkey AS id, p_name AS content, TRY_CAST(substr(p_brand, 7, 5) AS INTEGER) AS severity,
  TRY_CAST(p_name AS DOUBLE) AS number, CAST(p_size AS FLOAT) AS v0,
  round(CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE), 2) AS v1 FROM part""")
add("validate_dim", """
SELECT CAST(min(len(embedding)) AS INTEGER) AS min_dim, CAST(max(len(embedding)) AS INTEGER) AS max_dim,
  count(embedding) AS vectors FROM embeddings""")
add("corpus_uniqueness", """
SELECT 'doc_ref' AS what, md5(text) AS value, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1
UNION ALL SELECT 'section', lang || '-' || CAST(n_chars AS VARCHAR), count(*) FROM documents
  GROUP BY lang, n_chars HAVING count(*) > 1
UNION ALL SELECT 'part', part, count(*) FROM (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(
    text || ' MK-' || CAST(n_chars AS VARCHAR), '[A-Z]{2}-[0-9]+')) AS part FROM documents)
GROUP BY part HAVING count(*) > 1""")
add("corpus_copies", "SELECT md5(text) AS value, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
add("corpus_exclusions", """
SELECT p_partkey, component, mode FROM parts p WHERE NOT contains(component, 'gizmo') AND NOT EXISTS (
  SELECT 1 FROM parts c WHERE c.p_size = 50 AND c.p_type = 'ECONOMY' AND c.component = p.component
    AND c.mode = p.mode)""",
    ["parts AS (SELECT *, split_part(p_name, ' ', 2) AS component, split_part(p_name, ' ', 1) AS mode FROM part)"])
add("corpus_category_counts", "SELECT category, count(*) AS sections FROM manual GROUP BY category", [manual()])

# fixed values: keywords by rule, outcomes of rules, outcomes of categories
KEYWORDS = """
  (0, 'wear'), (0, 'backlash'), (0, 'elongation'), (0, 'misalignment'), (0, 'sag'), (0, 'scoring'),
  (0, 'fretting'), (0, 'alignment'), (0, 'index error'), (0, 'overshoot'), (0, 'seating error'),
  (0, 'dead zone'), (1, 'pitting'), (1, 'roughness'), (1, 'flat spotting'), (1, 'degradation'),
  (1, 'looseness'), (2, 'grip loss'), (2, 'slippage'), (2, 'slip'), (2, 'tension loss'), (2, 'creep'),
  (2, 'drift'), (3, 'leak'), (3, 'weep'), (3, 'bypass'), (3, 'leak-back'), (3, 'oil leak'), (3, 'excess flow'),
  (3, 'leakage'), (4, 'pressure loss'), (4, 'precharge loss'), (4, 'setpoint drift'), (4, 'hysteresis'),
  (4, 'null shift'), (4, 'chatter'), (4, 'sticking'), (4, 'imbalance'), (5, 'overheating'),
  (5, 'temperature rise'), (5, 'dew point rise'), (5, 'temperature swing'), (5, 'zone imbalance'),
  (5, 'cooling loss'), (6, 'insulation degradation'), (6, 'high impedance'), (6, 'ingress'),
  (7, 'overcurrent'), (7, 'ripple'), (7, 'hot joint'), (7, 'output droop'), (7, 'saturation'),
  (7, 'electrical erosion'), (8, 'phase error'), (8, 'intermittent output'), (8, 'CRC errors'),
  (8, 'channel failure'), (8, 'contact bounce'), (8, 'ground loop'), (8, 'loose connection'),
  (8, 'welded contacts'), (9, 'slow shift'), (9, 'asynchrony'), (9, 'cross fault'), (9, 'diagnostic fault'),
  (9, 'muting fault'), (9, 'false trip'), (9, 'slow to extend'), (10, 'flow restriction'), (10, 'restriction'),
  (10, 'blockage'), (10, 'loss of vacuum'), (10, 'flow loss'), (10, 'clogging'), (10, 'fouling'),
  (10, 'scaling'), (10, 'contamination'), (10, 'aeration'), (10, 'condensate build-up'),
  (10, 'bowl contamination'), (10, 'cushion loss'), (11, 'open circuit'), (12, 'bearing failure'), (13, 'icing')"""
RULES = """
  (0, 'mm', 0.02::DOUBLE, 0.9::DOUBLE, 'exceeds'), (1, 'mm/s RMS', 2.8::DOUBLE, 9.5::DOUBLE, 'rises above'),
  (2, 'Nm', 25.0::DOUBLE, 220.0::DOUBLE, 'falls below'), (3, 'ml/min', 5.0::DOUBLE, 90.0::DOUBLE, 'exceeds'),
  (4, 'bar', 3.0::DOUBLE, 240.0::DOUBLE, 'falls below'),
  (5, 'degrees C', -20.0::DOUBLE, 190.0::DOUBLE, 'climbs past'),
  (6, 'megohm', 1.0::DOUBLE, 60.0::DOUBLE, 'falls below'), (7, 'A', 2.0::DOUBLE, 180.0::DOUBLE, 'exceeds'),
  (8, 'mV', 8.0::DOUBLE, 400.0::DOUBLE, 'exceeds'), (9, 'ms', 40.0::DOUBLE, 480.0::DOUBLE, 'exceeds'),
  (10, 'l/min', 3.0::DOUBLE, 90.0::DOUBLE, 'drops under'),
  (11, 'megohm', 5.0::DOUBLE, 90.0::DOUBLE, 'exceeds'),
  (12, 'mm/s RMS', 3.2::DOUBLE, 11.0::DOUBLE, 'rises above'),
  (13, 'degrees C', -18.0::DOUBLE, 2.0::DOUBLE, 'falls below')"""
FALLBACK = """
  ('mechanical', 'mm', 0.02::DOUBLE, 0.4::DOUBLE, 'exceeds'),
  ('hydraulic', 'bar', 60.0::DOUBLE, 240.0::DOUBLE, 'falls below'),
  ('electrical', 'V', 12.0::DOUBLE, 640.0::DOUBLE, 'sags below'),
  ('thermal', 'degrees C', 35.0::DOUBLE, 190.0::DOUBLE, 'climbs past'),
  ('safety', 'ms', 40.0::DOUBLE, 480.0::DOUBLE, 'exceeds'),
  ('pneumatic', 'bar', 3.0::DOUBLE, 11.0::DOUBLE, 'falls below')"""
_pairs = re.findall(r"\((\d+), '([^']*)'\)", KEYWORDS)
_words = sorted({word for _, word in _pairs})
_listed = "[" + ", ".join(f"{{'n': {n}, 'word': '{word}'}}" for n, word in _pairs) + "]"
add("rule_lookup_first_match", f"""
SELECT s.id, s.category, CAST(s.n AS INTEGER) AS rule_no, coalesce(r.unit, b.unit) AS unit,
  CASE WHEN s.n IS NULL THEN b.low ELSE r.low END AS low, CASE WHEN s.n IS NULL THEN b.high ELSE r.high END AS high,
  coalesce(r.verb, b.verb) AS verb
FROM matched s LEFT JOIN rules r ON r.n = s.n LEFT JOIN fallback b ON b.category = s.category""",
    [f"rules(n, unit, low, high, verb) AS (VALUES {RULES})",
     f"fallback(category, unit, low, high, verb) AS (VALUES {FALLBACK})",
     "vectors AS (SELECT vec_id, label, count(*) OVER () AS total FROM embeddings)",
     "total AS (SELECT 1 AS one, max(total) AS total FROM vectors)",
     "placed AS (SELECT doc_id, text, doc_id % total AS vec_id FROM (SELECT *, 1 AS one FROM documents) JOIN total USING (one))",
     # every text gets one keyword by its id, or, in turn, none; without it the last element is NULL
     f"""reports AS (SELECT doc_id AS id, CASE label % 6 WHEN 0 THEN 'mechanical' WHEN 1 THEN 'hydraulic' WHEN 2 THEN 'electrical'
        WHEN 3 THEN 'thermal' WHEN 4 THEN 'safety' ELSE 'pneumatic' END AS category,
      text || coalesce(' shows ' || list_extract({_words!r}, CAST(doc_id % {len(_words) + 1} + 1 AS BIGINT)), '') AS content
      FROM placed JOIN vectors USING (vec_id))""",
     f"""matched AS (SELECT id, category, list_min(list_transform(list_filter({_listed}, lambda k: contains(content, k.word)),
       lambda k: k.n)) AS n FROM reports)"""])

# ---- models -----------------------------------------------------------------------------------


def _letter(text: str, letter: str) -> str:
    return f"CAST(length({text}) - length(replace(lower({text}), '{letter}', '')) AS FLOAT) AS {letter}"


def letters(key: str, text: str, table: str) -> str:
    return f"""
SELECT {key}, 26 AS dim, CAST(length(regexp_replace(lower({text}), '[^a-z]', '', 'g')) AS DOUBLE) AS letters,
  {_letter(text, 'a')}, {_letter(text, 'e')}, {_letter(text, 'z')} FROM {table}"""


add("ml_predict", letters("doc_id", "text", "documents"))
add("embed_text", letters("alarm_id", "alarm_text", "alarms"), [ALARMS])
QUOTED = """'{"diagnosis": "see ' || doc_ref || '"}'"""
add("plan_action", f"SELECT alarm_id, {QUOTED} AS ai_work_order FROM context", TO_CONTEXT)
add("prompt_assembly", """
SELECT alarm_id, md5(planner_input) AS digest, CAST(length(planner_input) AS INTEGER) AS chars FROM context""",
    TO_CONTEXT)

REPLIES_SQL = """replies AS (
  SELECT alarm_id, CASE eid % 6 WHEN 1 THEN '```json' || chr(10) || ai_work_order || chr(10) || '```'
    WHEN 2 THEN 'replace the seal; insufficient documentation otherwise' WHEN 3 THEN '' WHEN 4 THEN NULL
    ELSE ai_work_order END AS reply FROM orders)"""
add("work_order_parse", """
SELECT alarm_id, w->>'diagnosis' AS diagnosis, w->>'action' AS action,
  CAST(json_array_length(w, '$.parts') AS INTEGER) AS parts, w->>'safety' AS safety,
  CAST(w->>'estimated_minutes' AS INTEGER) AS estimated_minutes,
  CAST(w->>'line_stop_likely' AS BOOLEAN) AS line_stop_likely, md5(reply) AS raw
FROM (SELECT *, TRY_CAST(CASE WHEN starts_with(reply, '{') THEN reply END AS JSON) AS w FROM replies)""",
    [*TO_ORDERS, REPLIES_SQL])
add("grounding_guard", "SELECT alarm_id, contains(reply, 'insufficient documentation') AS ungrounded FROM replies",
    [*TO_ORDERS, REPLIES_SQL])

# ---- vector search ----------------------------------------------------------------------------

FOUND = f"h.id, category, severity, rank, {SCORE}"
BY_ALARM = f"SELECT alarm_id, {FOUND} FROM alarms a {{how}} JOIN hits h ON h.probe_id = a.probe_id " \
           "{how} JOIN manual m ON m.id = h.id"
BY_PROBE = f"SELECT probe_id, {FOUND} FROM hits h JOIN manual m ON m.id = h.id"


def by_alarm(how: str = "", **options) -> str:
    return with_(BY_ALARM.format(how=how), ALARMS, PROBES, manual(), hits(**options))


def by_probe(stretched: bool = False, **options) -> str:
    return with_(BY_PROBE, PROBES, manual(stretched), hits(**options))


ORACLES["vs_lateral_inner"] = by_alarm()
ORACLES["vs_lateral_left"] = by_alarm("LEFT")
ORACLES["vs_distinct_probes"] = by_alarm("LEFT", k=2)
ORACLES["vs_topk_gt_1"] = by_alarm(k=4)
ORACLES["vs_metric_cosine"] = by_probe(stretched=True, k=3)
ORACLES["vs_metric_ip"] = by_probe(stretched=True, k=3, metric="IP")
ORACLES["vs_metric_l2"] = by_probe(stretched=True, k=3, metric="L2")
ORACLES["vs_prefilter"] = by_probe(k=2, where="category = 'safety'")
ORACLES["vs_probe_width"] = by_probe()
ORACLES["vs_blocked"] = by_probe(k=5)
ORACLES["vs_ann_exhaustive"] = by_probe(k=3)
ORACLES["vs_ann_index"] = by_probe(k=3)
add("vs_constant_probe", """
SELECT id, category, severity, round(list_cosine_similarity(CAST(vec AS DOUBLE[]),
    CAST(list_transform(range(64), lambda i: CAST(0.01 AS FLOAT)) AS DOUBLE[])), 6) AS score
FROM manual ORDER BY list_cosine_similarity(CAST(vec AS DOUBLE[]),
    CAST(list_transform(range(64), lambda i: CAST(0.01 AS FLOAT)) AS DOUBLE[])) DESC, id LIMIT 3""", [manual()])
add("vs_null_probe", """
SELECT a.probe_id IS NULL AS without_vector, count(*) AS alarms, count(h.id) AS hits
FROM alarms a LEFT JOIN hits h ON h.probe_id = a.probe_id GROUP BY 1""", TO_HITS)

# ---- enrichment -------------------------------------------------------------------------------

for _name, _columns in {
    "match_confidence": "match_confidence",
    "priority": "severity, criticality, priority",
    "queue": "category, queue",
    "sla_due": "t_alarm, sla_due",
    "interval_nudge": "t_context, t_context + INTERVAL 1 MILLISECOND AS nudged",
    "score_cast": "CAST(score AS DOUBLE) AS stored",
    "project_rename": "alarm_id AS incident_id, matched_section AS section, doc_ref",
    "text_cast_number": "CAST(vibration_mms AS VARCHAR) AS vibration, CAST(temp_c AS VARCHAR) AS temp",
    "round_cast": "CAST(round(CAST(score AS DOUBLE), 3) AS VARCHAR) AS shown",
    "coalesce_text": "coalesce(CASE WHEN match_confidence <> 'low' THEN doc_ref END, 'no match') AS retrieved",
    "typed_null": "CAST(NULL AS VARCHAR) AS note",
}.items():
    add(_name, f"SELECT alarm_id, {_columns} FROM context", TO_CONTEXT)
add("shift_of_time", """
SELECT event_id, CASE WHEN hour(ts) >= 6 AND hour(ts) < 14 THEN 'A' WHEN hour(ts) >= 14 AND hour(ts) < 22 THEN 'B'
  ELSE 'C' END AS shift FROM events""")
add("like_contains", "SELECT alarm_id, ai_work_order LIKE '%insufficient documentation%' AS refused FROM orders",
    TO_ORDERS)
add("truncate_text", """
SELECT doc_id, CASE WHEN length(text) > 74 THEN substr(text, 1, 74) || '...' ELSE text END AS shown FROM documents""")

# ---- status log -------------------------------------------------------------------------------

for _name, _seq in {"status_received": "1", "status_context": "2", "status_triaged": "3", "status_action": "4",
                    "status_log": "seq"}.items():
    add(_name, f"SELECT * FROM pipeline_log WHERE seq = {_seq}", [*TO_ORDERS, PIPELINE_LOG_SQL])

# ---- incident store ---------------------------------------------------------------------------

add("incident_merge", "SELECT * EXCLUDE (eid, full_score) FROM incident", TO_INCIDENT)
AGAIN = """attempts AS (
  SELECT alarm_id AS incident_id, ai_work_order, t_action FROM orders
  UNION ALL SELECT alarm_id, 'planned again', t_action + INTERVAL 2 MINUTE FROM orders WHERE eid % 3 = 0)"""
add("upsert_first_wins", """
SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY t_action) = 1""",
    [*TO_ORDERS, AGAIN])
add("upsert_last_wins", """
SELECT * FROM attempts QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY t_action DESC) = 1""",
    [*TO_ORDERS, AGAIN])
add("lag_columns", "SELECT incident_id, retrieval_lag_ms, planning_lag_ms, total_lag_ms FROM incident", TO_INCIDENT)
add("created_at_default", "SELECT count(*) AS n, count(t_context) AS stamped FROM context", TO_CONTEXT)
add("latest_status", "SELECT * FROM latest", [*TO_LOG, LATEST_SQL])
add("incident_current", "SELECT * EXCLUDE (eid, full_score) FROM current", TO_CURRENT)
add("needs_human", "SELECT incident_id, status, needs_human FROM current", TO_CURRENT)
add("ever_needed_human", """
SELECT incident_id, bool_or(status IN ('NEEDS_CONTEXT', 'NEEDS_REVIEW')) AS ever_needed_human
FROM log GROUP BY incident_id""", TO_LOG)
add("sla_breached", "SELECT incident_id, sla_due, sla_breached FROM current", TO_CURRENT)
add("stream_incident_current", "SELECT * EXCLUDE (eid, full_score) FROM current", TO_CURRENT)
add("stream_sla_breached", f"""
SELECT alarm_id AS incident_id FROM context JOIN (
  SELECT incident_id, status FROM log WHERE at_ts <= {NOW}
  QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY at_ts DESC, seq DESC) = 1) ON incident_id = alarm_id
WHERE t_context <= {NOW} AND sla_due < {NOW} AND status NOT IN {ENDED}""", TO_LOG)
add("human_transition", "SELECT * FROM human_log", [ACTIONS_SQL])
add("stream_human_actions", "SELECT * FROM human_log", [ACTIONS_SQL])
add("human_columns", "SELECT incident_id, assignee, manual_action, resolution_notes FROM incident", TO_INCIDENT)
add("incident_lookup", "SELECT * EXCLUDE (eid, full_score) FROM current WHERE incident_id = '1001'", TO_CURRENT)


def delta(ms: str) -> str:
    return f"""CASE WHEN {ms} IS NULL THEN NULL WHEN {ms} < 1000 THEN printf('+%d ms', {ms})
    WHEN {ms} < 60000 THEN printf('+%.1f s', {ms} / 1000.0::DOUBLE)
    WHEN {ms} < 3600000 THEN printf('+%.0f min', {ms} / 60000.0::DOUBLE)
    WHEN {ms} < 86400000 THEN printf('+%.1f h', {ms} / 3600000.0::DOUBLE)
    ELSE printf('+%.1f d', {ms} / 86400000.0::DOUBLE) END"""


add("timeline_delta", f"""
SELECT *, {delta('delta_ms')} AS delta FROM (
  SELECT *, date_diff('millisecond', lag(at_ts) OVER (PARTITION BY incident_id ORDER BY at_ts, seq), at_ts) AS delta_ms
  FROM log)""", TO_LOG)
add("format_delta", f"""
SELECT doc_id, ms, {delta('ms')} AS delta FROM (
  SELECT doc_id, n_chars * CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 40000 END AS ms FROM documents)""")

RANK = "CASE priority WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 ELSE 4 END"
LISTED = """incident_id, asset_id, line_id, fault_code, alarm_text, priority, queue, doc_ref, matched_section,
  match_confidence, score, status, needs_human, sla_breached, sla_due, assignee, total_lag_ms, t_alarm"""
OPEN = f"status NOT IN {ENDED}"
for _name, _where in {"attention": f"needs_human AND {OPEN}", "open": OPEN, "breached": "sla_breached",
                      "all": "TRUE"}.items():
    add(f"view_{_name}", f"""
SELECT {LISTED} FROM current WHERE {_where}
ORDER BY needs_human DESC NULLS FIRST, {RANK}, sla_due ASC NULLS LAST, incident_id LIMIT 200""", TO_CURRENT)
add("view_counts", f"""
SELECT count(*) FILTER (WHERE needs_human AND {OPEN}) AS attention, count(*) FILTER (WHERE {OPEN}) AS open,
  count(*) FILTER (WHERE sla_breached) AS breached, count(*) AS "all" FROM current""", TO_CURRENT)
add("inspect_triage", f"""
SELECT priority, queue, asset_id, doc_ref, matched_section, {SCORE}, match_confidence, sla_due FROM orders""",
    TO_ORDERS)

# ---- dashboards -------------------------------------------------------------------------------

add("dash_last_hour", f"""
SELECT count(*) AS value FROM incident WHERE created_at > {NOW} - INTERVAL 1 HOUR AND created_at <= {NOW}""",
    TO_INCIDENT)
add("dash_needs_human", f"SELECT count(*) AS value FROM current WHERE needs_human AND {OPEN}", TO_CURRENT)
add("dash_sla_breached", "SELECT count(*) AS value FROM current WHERE sla_breached", TO_CURRENT)
QUARTER = f"> {NOW} - INTERVAL 15 MINUTE AND t_action <= {NOW}"
PANEL = "> TIMESTAMP '2024-01-06 06:30:00' AND {0} <= TIMESTAMP '2024-01-17 18:00:00'"
ACTED, CREATED = "t_action " + PANEL.format("t_action"), "created_at " + PANEL.format("created_at")
QUIET = "t_action > TIMESTAMP '2023-01-01 00:00:00' AND t_action <= TIMESTAMP '2023-01-02 00:00:00'"
for _name, _p, _when in (("dash_p50", 0.5, f"t_action {QUARTER}"), ("dash_p95", 0.95, f"t_action {QUARTER}"),
                         ("dash_p95_range", 0.95, ACTED), ("dash_p50_quiet", 0.5, QUIET)):
    add(_name, f"SELECT round(coalesce(quantile_cont(total_lag_ms, {_p}), 0), 6) AS value FROM incident WHERE {_when}",
        TO_INCIDENT)
add("dash_grounded_pct", f"""
SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE NOT needs_human) / nullif(count(*), 0)) AS value FROM current
WHERE created_at > {NOW} - INTERVAL 1 HOUR AND created_at <= {NOW}""", TO_CURRENT)
add("dash_latency_series", f"""
SELECT CAST(date_trunc('minute', t_action) AS TIMESTAMP) AS minute, round(avg(retrieval_lag_ms), 6) AS retrieval_ms,
  round(avg(planning_lag_ms), 6) AS planning_ms, round(avg(total_lag_ms), 6) AS total_ms
FROM incident WHERE {ACTED} GROUP BY 1""", TO_INCIDENT)
add("dash_time_split", f"""
SELECT round(avg(retrieval_lag_ms)) AS retrieval_ms, round(avg(planning_lag_ms)) AS planning_ms,
  round(avg(total_lag_ms)) AS total_ms, max(total_lag_ms) AS worst_ms FROM incident WHERE {ACTED}""",
    TO_INCIDENT)
add("dash_status_pie", f"SELECT status, count(*) AS incidents FROM current WHERE {CREATED} GROUP BY status", TO_CURRENT)
add("sum_status", "SELECT status, count(*) AS incidents FROM current GROUP BY status", TO_CURRENT)
add("dash_priority_by_queue", f"""
SELECT queue, count(*) FILTER (WHERE priority = 'P1') AS P1, count(*) FILTER (WHERE priority = 'P2') AS P2,
  count(*) FILTER (WHERE priority = 'P3') AS P3, count(*) FILTER (WHERE priority = 'P4') AS P4, count(*) AS total
FROM incident WHERE {CREATED} GROUP BY queue""", TO_INCIDENT)
add("dash_confidence", f"""
SELECT match_confidence AS confidence, count(*) AS incidents, round(min(full_score), 3) AS worst,
  round(avg(full_score), 3) AS average, round(max(full_score), 3) AS best
FROM incident WHERE {CREATED} GROUP BY 1""", TO_INCIDENT)
add("dash_top_sections", f"""
SELECT doc_ref, matched_section AS section, count(*) AS hits, round(avg(full_score), 3) AS avg_score
FROM incident WHERE {CREATED} GROUP BY 1, 2 ORDER BY hits DESC, doc_ref LIMIT 10""", TO_INCIDENT)
add("dash_waiting", f"""
SELECT incident_id, asset_id, fault_code, priority, status, coalesce(doc_ref, 'none') AS retrieved,
  round(full_score, 3) AS score, sla_due FROM current WHERE needs_human AND {OPEN}
ORDER BY {RANK}, sla_due ASC NULLS LAST, incident_id LIMIT 20""", TO_CURRENT)
add("sum_human_rate", """
SELECT count(*) FILTER (WHERE needs_human) AS needs_human, count(*) AS total,
  round(100.0::DOUBLE * count(*) FILTER (WHERE needs_human) / nullif(count(*), 0), 1) AS pct FROM current""",
    TO_CURRENT)
add("sum_latency", """
SELECT round(avg(retrieval_lag_ms)) AS embed_retrieve_ms, round(avg(planning_lag_ms)) AS planner_ms,
  CAST(round(quantile_cont(total_lag_ms, 0.5)) AS INTEGER) AS p50_ms,
  CAST(round(quantile_cont(total_lag_ms, 0.95)) AS INTEGER) AS p95_ms FROM incident WHERE total_lag_ms IS NOT NULL""",
    TO_INCIDENT)

# ---- audit ------------------------------------------------------------------------------------


def verdicts(source: str) -> str:
    return f"""mapping(code, target) AS (
  VALUES ('PURCHASE', 'SM-0'), ('SIGNUP', 'SM-1'), ('VIEW', 'SM-2'), ('CLICK', NULL)),
wanted AS (
  SELECT o.*, CASE WHEN code IS NULL THEN '?' ELSE target END AS expected
  FROM {source} o LEFT JOIN mapping ON code = fault_code),
verdicts AS (
  SELECT *, expected IS NOT NULL AS covered,
    CASE WHEN expected IS NULL THEN match_confidence = 'low' ELSE expected = doc_ref END AS correct FROM wanted)"""


add("audit_rows", f"""
SELECT alarm_id, fault_code, doc_ref, expected, {SCORE}, correct,
  CASE WHEN correct THEN 'ok' WHEN covered THEN 'MISMATCH'
    ELSE 'SCORED ' || match_confidence || ', WANTED low' END AS result FROM verdicts""",
    [*TO_ORDERS, verdicts("orders")])
BOUNDS = "round(CAST(min(score) AS DOUBLE), 6) AS min_score, round(CAST(max(score) AS DOUBLE), 6) AS max_score"
add("audit_summary", f"""
SELECT count(*) FILTER (WHERE correct) AS correct, count(*) AS total, count(*) FILTER (WHERE covered) AS covered,
  count(*) FILTER (WHERE NOT covered) AS uncovered, {BOUNDS} FROM verdicts""", [*TO_ORDERS, verdicts("orders")])
add("audit_exhaustive", f"""
SELECT covered, count(*) AS alarms, count(*) FILTER (WHERE correct) AS correct, {BOUNDS}
FROM verdicts GROUP BY covered""", [*TO_CONTEXT, verdicts("context")])
add("calibrate_threshold", """
SELECT round(CAST(cut AS DOUBLE), 6) AS cut, CAST(caught AS BIGINT) AS caught, CAST(flagged AS BIGINT) AS flagged
FROM cuts ORDER BY caught DESC, flagged, cuts.cut LIMIT 1""",
    [*TO_ORDERS, verdicts("orders"), """cuts AS (
  SELECT score AS cut,
    coalesce(sum(u) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caught,
    coalesce(sum(c) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS flagged
  FROM (SELECT score, count(*) FILTER (WHERE NOT covered) AS u, count(*) FILTER (WHERE covered) AS c
        FROM verdicts GROUP BY score))"""])

# ---- streams: the batch results are their twins -------------------------------------------------

QUOTED_ORDERS = ORDERS_SQL.replace("orders AS", "template_orders AS") + f""",
orders AS (SELECT * REPLACE ({QUOTED} AS ai_work_order) FROM template_orders)"""
TO_QUOTED = [*TO_CONTEXT, QUOTED_ORDERS]
add("stream_orders", f"SELECT alarm_id, doc_ref, priority, {SCORE}, t_action, ai_work_order FROM orders", TO_QUOTED)
add("stream_incident", """
SELECT incident_id, priority, queue, created_at, retrieval_lag_ms, planning_lag_ms, total_lag_ms FROM incident""",
    [*TO_QUOTED, ACTIONS_SQL, INCIDENT_SQL.replace(f" WHERE t_action <= {NOW}", "")])  # the stream has them all
add("stream_status", "SELECT * FROM pipeline_log", [*TO_QUOTED, PIPELINE_LOG_SQL])
