"""Every registered query: name -> (spark, sf_dir) -> DataFrame. All run over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions import text, triage
from faultline.functions.clock import plus_millis
from faultline.operators import audit as audits
from faultline.operators import cells, codes, corpus, status, store
from faultline.operators.conform import conform, dimensions
from faultline.operators.joins import lookup
from faultline.operators.models import ModelSpec, letter_counts, ml_predict, quoting_planner
from faultline.operators.timeline import timelines
from faultline.operators.vector_search import constant_search, vector_search
from faultline.plans import metrics, retrieve, views
from faultline.schemas import MANUAL, WORK_ORDER
from faultline.session import configure, materialize, run_dir, shared_dir
from faultline.sources import streams, tables
from faultline.streaming import sinks, stages, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LETTERS = ModelSpec("letters", "ARRAY<FLOAT>", letter_counts)
QUOTING = ModelSpec("quoting", "STRING", quoting_planner)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)
    QUERIES[function.__name__] = run
    return function


def moment(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


AS_OF = "2024-01-20 00:00:00"
SINCE, UNTIL = "2024-01-06 06:30:00", "2024-01-17 18:00:00"  # the range of the panels: open, closed


def panel_range() -> tuple[Column, Column]:
    return moment(SINCE), moment(UNTIL)


def last(interval: str) -> tuple[Column, Column]:
    return moment(AS_OF) - F.expr(f"INTERVAL {interval}"), moment(AS_OF)


# ---- the shared inputs ------------------------------------------------------------------------

def stage_one(spark, sf) -> DataFrame:
    """Context records as their readers get them: written once, without re-entering the search."""
    return materialize(retrieve.context(spark, sf).drop("planner_input"), "context")


def orders_of(spark, sf) -> DataFrame:
    return retrieve.work_orders(retrieve.context(spark, sf))


def human(spark, sf) -> tuple[DataFrame, DataFrame]:
    return store.apply_actions(tables.actions(spark, sf))


def log_of(spark, sf, ctx: DataFrame | None = None) -> DataFrame:
    ctx = ctx if ctx is not None else stage_one(spark, sf)
    log, _ = human(spark, sf)
    return status.status_log(tables.alarms(spark, sf), ctx, retrieve.work_orders(ctx)).unionByName(log)


def families(ctx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contexts, and the orders that had arrived at the moment asked about."""
    arrived = retrieve.work_orders(ctx).where(F.col("t_action") <= moment(AS_OF))
    return store.context_family(ctx, created_at=F.col("t_context")), store.action_family(arrived)


def incident_of(spark, sf, ctx: DataFrame | None = None) -> DataFrame:
    ctx, act = families(ctx if ctx is not None else stage_one(spark, sf))
    _, hum = human(spark, sf)
    return store.merge_incidents(ctx, act, hum)


def current_of(spark, sf) -> DataFrame:
    return store.current_of_records(
        retrieve.planned(retrieve.context(spark, sf)), tables.alarms(spark, sf), tables.actions(spark, sf), moment(AS_OF),
        created_at=F.col("t_context"), arrived=F.col("t_action") <= moment(AS_OF))


def score6() -> Column:
    return F.round(F.col("score").cast("double"), 6).alias("score")


# ---- flagship ---------------------------------------------------------------------------------

@query
def retrieve_enrich(spark, sf):
    return retrieve.context(spark, sf).withColumn("score", score6()).withColumn(
        "planner_input", F.md5("planner_input"))


# ---- sources and sinks ------------------------------------------------------------------------

@query
def src_json_lenient(spark, sf):
    """Alarm records as JSON text, some broken, some with a bad field or an ISO timestamp."""
    id_ = F.col("alarm_id").cast("long")
    when = F.date_format("alarm_time", "yyyy-MM-dd HH:mm:ss.SSS")
    when = F.when(id_ % 13 == 3, F.replace(when, F.lit(" "), F.lit("T"))).otherwise(when)
    temp = F.when(id_ % 11 == 4, F.lit('"x"')).otherwise(F.col("temp_c").cast("string"))
    record = F.format_string(
        '{"alarm_id":"%s","temp_c":%s,"alarm_time":"%s","extra":[1],"fault_code":"%s"}',
        "alarm_id", temp, when, "fault_code")
    value = F.when(id_ % 7 == 2, F.concat(F.lit("{broken "), "alarm_id")).otherwise(record)
    raw = tables.alarms(spark, sf).select(value.alias("value"))
    return streams.alarms(raw).select("alarm_id", "fault_code", "temp_c", "alarm_text", "alarm_time")


REPLAYED = ["asset_id", "alarm_text", "matched_section", "doc_ref", "category", "severity", "score",
            "match_confidence", "priority", "queue", "sla_due", "ai_work_order"]


@query
def src_topic_batch_replay(spark, sf):
    """The order records as JSON, read back with fewer columns than they hold."""
    declared = T.StructType([WORK_ORDER[c] for c in REPLAYED])
    records = sinks.keyed_json(orders_of(spark, sf))
    return streams.parse(records, declared).withColumn("score", score6())


@query
def src_corpus_table(spark, sf):
    return conform(tables.manual(spark, sf), MANUAL, "id").select(
        "id", F.md5("content").alias("content"), "category", "section", "doc_ref", "severity",
        F.size("vec").alias("dim"))


@query
def snk_keyed_by_asset(spark, sf):
    records = sinks.keyed_json(orders_of(spark, sf))
    return records.select("key", F.get_json_object("value", "$.alarm_id").alias("alarm_id"),
                          F.get_json_object("value", "$.t_action").alias("t_action"))


@query
def snk_incident_context(spark, sf):
    ctx, _ = families(retrieve.context(spark, sf))
    return store.first_wins(ctx, "incident_id", "t_context").withColumn("score", score6())


@query
def snk_incident_action(spark, sf):
    act = store.action_family(orders_of(spark, sf))
    return store.first_wins(act, "incident_id", "t_action")


@query
def snk_corpus_overwrite(spark, sf):
    """Ids 0..n-1 in the order of the corpus."""
    shared_dir(spark)
    docs = tables.read(spark, sf, "documents").select("source", "doc_id", F.md5("text").alias("content"))
    return corpus.number_rows(docs, ["source", "doc_id"])


# ---- corpus -----------------------------------------------------------------------------------

@query
def conform_schema(spark, sf):
    """Parts brought to other types; text that is no number becomes NULL."""
    loose = tables.read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("content"),
        F.col("p_brand").substr(7, 5).alias("severity"), F.col("p_name").alias("number"),
        F.array(F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")).alias("vec"))
    declared = T.StructType.fromDDL("id BIGINT, content STRING, severity INT, number DOUBLE, vec ARRAY<FLOAT>")
    done = conform(loose, declared, "id")
    return done.select("id", "content", "severity", "number", F.col("vec")[0].alias("v0"),
                       F.round(F.col("vec")[1].cast("double"), 2).alias("v1"))


@query
def validate_dim(spark, sf):
    return dimensions(tables.read(spark, sf, "embeddings"), "embedding")


@query
def corpus_uniqueness(spark, sf):
    """Documents as a corpus that breaks every rule: a reference per text, a title per language and
    length, and a part number per length appended to the text."""
    chars = F.col("n_chars").cast("string")
    docs = tables.read(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.concat("text", F.lit(" MK-"), chars).alias("content"),
        F.concat("lang", F.lit("-"), chars).alias("section"), F.md5("text").alias("doc_ref"))
    return corpus.uniqueness(docs)


@query
def corpus_copies(spark, sf):
    """Sections that share their whole text with another."""
    return corpus.repeated(tables.read(spark, sf, "documents"), F.md5("text"))


@query
def corpus_exclusions(spark, sf):
    """Part names as (component, mode); the parts of size 50 stand for the curated pairs."""
    parts = tables.read(spark, sf, "part").select(
        "p_partkey", "p_type", "p_size", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("component"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("mode"))
    curated = parts.where((F.col("p_size") == 50) & (F.col("p_type") == "ECONOMY"))
    return corpus.exclude(parts, "component", "mode", curated, topics=("gizmo",)).select(
        "p_partkey", "component", "mode")


@query
def corpus_category_counts(spark, sf):
    return corpus.category_counts(tables.manual(spark, sf))


@query
def rule_lookup_first_match(spark, sf):
    """Every text ends with a keyword chosen by its id, or with none, so that all rules and the fallback occur."""
    words = sorted({w for rule in corpus.MODE_RULES for w in rule[0]})
    word = F.array(*map(F.lit, words))[(F.col("id") % (len(words) + 1)).cast("int")]
    ending = F.when(F.col("id") % (len(words) + 1) < len(words), F.concat(F.lit(" shows "), word)).otherwise("")
    sections = tables.manual(spark, sf).select("id", "category", F.concat("content", ending).alias("content"))
    known = corpus.KeywordRules(spark.createDataFrame(
        [(n, w) for n, rule in enumerate(corpus.MODE_RULES) for w in rule[0]], "rule_no INT, word STRING"))
    outcome = "unit STRING, low DOUBLE, high DOUBLE, verb STRING"
    rules = spark.createDataFrame([(n, *rule[1:]) for n, rule in enumerate(corpus.MODE_RULES)], f"rule_no INT, {outcome}")
    fallback = spark.createDataFrame([(c, *v) for c, v in corpus.CATEGORY_RULES.items()], f"category STRING, {outcome}")
    found = sections.select("id", "category", known.first(F.col("content")).alias("rule_no"))
    named = found.join(rules, "rule_no", "left").join(fallback.alias("f"), "category", "left")
    return named.select("id", "category", "rule_no", *[F.when(F.col("rule_no").isNull(), F.col(f"f.{c}")).otherwise(
        rules[c]).alias(c) for c in ("unit", "low", "high", "verb")])


# ---- models -----------------------------------------------------------------------------------

def letters_of(vec: str) -> list[Column]:
    total = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x)
    return [F.size(vec).alias("dim"), total.alias("letters"), F.col(vec)[0].alias("a"), F.col(vec)[4].alias("e"),
            F.col(vec)[25].alias("z")]


@query
def model_predict(spark, sf):
    """Embedding call over the whole text of every document."""
    docs = tables.read(spark, sf, "documents").select("doc_id", "text")
    return ml_predict(docs, LETTERS, "text", out="vec").select("doc_id", *letters_of("vec"))


QUERIES["ml_predict"] = QUERIES.pop("model_predict")


@query
def embed_text(spark, sf):
    """Alarm texts repeat: one call per distinct text."""
    asked = tables.alarms(spark, sf).select("alarm_id", "alarm_text")
    done = ml_predict(asked, LETTERS, "alarm_text", out="alarm_vector", distinct=True)
    return done.select("alarm_id", *letters_of("alarm_vector"))


@query
def plan_action(spark, sf):
    asked = retrieve.context(spark, sf).select("alarm_id", "planner_input")
    return ml_predict(asked, QUOTING, "planner_input", out="ai_work_order", batch_size=1).select(
        "alarm_id", "ai_work_order")


@query
def prompt_assembly(spark, sf):
    prompt = F.col("planner_input")
    return retrieve.context(spark, sf).select(
        "alarm_id", F.md5(prompt).alias("digest"), F.length(prompt).alias("chars"))


def replies(spark, sf) -> DataFrame:
    """Work orders whose reply is also fenced, prose, empty or missing."""
    orders = orders_of(spark, sf).select("alarm_id", "ai_work_order")
    kind, reply = F.col("alarm_id").cast("long") % 6, F.col("ai_work_order")
    varied = (F.when(kind == 1, F.concat(F.lit("```json\n"), reply, F.lit("\n```")))
              .when(kind == 2, "replace the seal; insufficient documentation otherwise")
              .when(kind == 3, "").when(kind == 4, F.lit(None).cast("string")).otherwise(reply))
    return orders.select("alarm_id", varied.alias("reply"))


@query
def work_order_parse(spark, sf):
    parsed = replies(spark, sf).withColumn("w", text.work_order(F.col("reply")))
    return parsed.select("alarm_id", "w.diagnosis", "w.action", F.array_size("w.parts").alias("parts"), "w.safety",
                         "w.estimated_minutes", "w.line_stop_likely", F.md5("reply").alias("raw"))


@query
def grounding_guard(spark, sf):
    return replies(spark, sf).select("alarm_id", text.ungrounded(F.col("reply")).alias("ungrounded"))


# ---- vector search ----------------------------------------------------------------------------

PAYLOAD = ["id", "category", "severity"]


def searched(spark, sf, probe_rows: DataFrame, key: str, stretched: bool = False, **options) -> DataFrame:
    manual = tables.manual(spark, sf, stretched)
    hits = vector_search(probe_rows, manual, "alarm_vector", "vec", key=key, payload=PAYLOAD, **options)
    return hits.select(key, *PAYLOAD, "rank", score6())


def alarm_search(spark, sf, **options) -> DataFrame:
    return searched(spark, sf, tables.with_vectors(spark, sf), "alarm_id", **options)


def probe_search(spark, sf, **options) -> DataFrame:
    return searched(spark, sf, tables.probes(spark, sf), "probe_id", **options)


@query
def vs_lateral_inner(spark, sf):
    return alarm_search(spark, sf)


@query
def vs_lateral_left(spark, sf):
    return alarm_search(spark, sf, how="left")


@query
def vs_distinct_probes(spark, sf):
    return alarm_search(spark, sf, distinct_by="probe_id", how="left", k=2)


@query
def vs_constant_probe(spark, sf):
    found = constant_search(tables.manual(spark, sf), [0.01] * 64, "vec", 3)
    return found.select("id", "category", "severity", score6())


@query
def vs_metric_cosine(spark, sf):
    return probe_search(spark, sf, stretched=True, k=3, metric="COSINE")


@query
def vs_metric_ip(spark, sf):
    return probe_search(spark, sf, stretched=True, k=3, metric="IP")


@query
def vs_metric_l2(spark, sf):
    return probe_search(spark, sf, stretched=True, k=3, metric="L2")


@query
def vs_prefilter(spark, sf):
    return probe_search(spark, sf, k=2, where="category = 'safety'")


@query
def vs_null_probe(spark, sf):
    """How many hits the rows without a vector have, and the others."""
    hits = alarm_search(spark, sf, how="left")
    asked = lookup(hits, tables.alarms(spark, sf).select("alarm_id", "probe_id"), "alarm_id")
    return asked.groupBy(F.col("probe_id").isNull().alias("without_vector")).agg(
        F.count("*").alias("alarms"), F.count("id").alias("hits"))


@query
def vs_probe_width(spark, sf):
    wide = tables.probes(spark, sf).withColumn("alarm_vector", F.col("alarm_vector").cast("array<double>"))
    return searched(spark, sf, wide, "probe_id")


@query
def vs_topk_gt_1(spark, sf):
    return alarm_search(spark, sf, k=4)


@query
def vs_blocked(spark, sf):
    """The tiled search; tiles stay small enough that probes and corpus take several even here."""
    return probe_search(spark, sf, k=5, strategy="blocked", smallest_tile=256)


@query
def vs_ann_index(spark, sf):
    """Search through an index of quantised codes that was built once; its bounds lose no hit."""
    rows = tables.manual(spark, sf).select("id", F.col("vec").alias("cv"))
    return probe_search(spark, sf, k=3, strategy="codes", built=codes.build_codes(rows, 16))


@query
def vs_ann_exhaustive(spark, sf):
    """Cell-routed search that visits every cell of a fitted index: must equal the exhaustive one."""
    return probe_search(spark, sf, k=3, strategy="cells", cells=8, nprobe=8)


@query
def vs_ann_recall(spark, sf):
    """Recall@10 by number of visited cells."""
    manual, probes = tables.manual(spark, sf).select("id", "vec"), tables.probes(spark, sf)
    placed, centroids = cells.build_cells(manual.withColumnRenamed("vec", "cv"), "cv", 16)
    asked = probes.select(F.col("probe_id").alias("key"), F.col("alarm_vector").alias("pv"))
    exact = materialize(cells.routed_hits(cells.route(asked, centroids, "pv", 16), placed, "COSINE", 10, 16), "exact")
    rows = []
    for visited in (1, 4, 16):
        found = cells.routed_hits(cells.route(asked, centroids, "pv", visited), placed, "COSINE", 10, 16)
        rows.append(cells.recall(found, exact, "key").select(F.lit(visited).alias("visited"), "recall"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# ---- enrichment -------------------------------------------------------------------------------

def _late(build: Callable[[], list]) -> Query:
    """Columns of the context record, built when the query runs (expressions need a live session)."""
    return lambda spark, sf: retrieve.context(configure(spark), sf).select("alarm_id", *build())


QUERIES["match_confidence"] = _late(lambda: ["match_confidence"])
QUERIES["priority"] = _late(lambda: ["severity", "criticality", "priority"])
QUERIES["queue"] = _late(lambda: ["category", "queue"])
QUERIES["sla_due"] = _late(lambda: ["t_alarm", "sla_due"])
QUERIES["interval_nudge"] = _late(lambda: [
    "t_context", (F.col("t_context") + F.expr("INTERVAL '0.001' SECOND")).alias("nudged")])
QUERIES["score_cast"] = _late(lambda: [
    F.col("score").cast("double").alias("stored")])
QUERIES["project_rename"] = _late(lambda: [
    F.col("alarm_id").alias("incident_id"), F.col("matched_section").alias("section"), "doc_ref"])
QUERIES["text_cast_number"] = _late(lambda: [
    F.col("vibration_mms").cast("string").alias("vibration"), F.col("temp_c").cast("string").alias("temp")])
QUERIES["round_cast"] = _late(lambda: [
    F.round(F.col("score").cast("double"), 3).cast("string").alias("shown")])
QUERIES["coalesce_text"] = _late(lambda: [
    F.coalesce(F.when(F.col("match_confidence") != "low", F.col("doc_ref")), F.lit("no match")).alias("retrieved")])
QUERIES["typed_null"] = _late(lambda: [F.lit(None).cast("string").alias("note")])


@query
def shift_of_time(spark, sf):
    return tables.read(spark, sf, "events").select("event_id", triage.shift_of(F.col("ts")).alias("shift"))


@query
def like_contains(spark, sf):
    return orders_of(spark, sf).select(
        "alarm_id", F.col("ai_work_order").like("%insufficient documentation%").alias("refused"))


@query
def truncate_text(spark, sf):
    return tables.read(spark, sf, "documents").select("doc_id", text.truncated(F.col("text")).alias("shown"))


# ---- status log -------------------------------------------------------------------------------

@query
def status_received(spark, sf):
    return status.status_received(tables.alarms(spark, sf))


@query
def status_context(spark, sf):
    return status.status_context(retrieve.context(spark, sf))


@query
def status_triaged(spark, sf):
    return status.status_triaged(retrieve.context(spark, sf))


@query
def status_action(spark, sf):
    return status.status_action(orders_of(spark, sf))


@query
def status_log(spark, sf):
    ctx = stage_one(spark, sf)
    return status.status_log(tables.alarms(spark, sf), ctx, retrieve.work_orders(ctx))


# ---- incident store ---------------------------------------------------------------------------

def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("score", score6())


@query
def incident_merge(spark, sf):
    return shown(incident_of(spark, sf))


def replayed(spark, sf) -> DataFrame:
    """Work orders, every third of them planned a second time two minutes later."""
    orders = orders_of(spark, sf)
    again = orders.where(F.col("alarm_id").cast("long") % 3 == 0).withColumn(
        "ai_work_order", F.lit("planned again")).withColumn("t_action", plus_millis(F.col("t_action"), F.lit(120000)))
    return store.action_family(orders.unionByName(again))


@query
def upsert_first_wins(spark, sf):
    return store.first_wins(replayed(spark, sf), "incident_id", "t_action")


@query
def upsert_last_wins(spark, sf):
    return store.last_wins(replayed(spark, sf), "incident_id", "t_action")


@query
def lag_columns(spark, sf):
    return incident_of(spark, sf).select("incident_id", "retrieval_lag_ms", "planning_lag_ms", "total_lag_ms")


@query
def created_at_default(spark, sf):
    """Without an explicit stamp every row gets the ingest time: none may lack it."""
    ctx = store.context_family(retrieve.context(spark, sf))
    return ctx.agg(F.count("*").alias("n"), F.count("created_at").alias("stamped"))


@query
def latest_status(spark, sf):
    return store.latest_status(log_of(spark, sf))


@query
def incident_current(spark, sf):
    return shown(current_of(spark, sf))


@query
def needs_human(spark, sf):
    return current_of(spark, sf).select("incident_id", "status", "needs_human")


@query
def ever_needed_human(spark, sf):
    return store.ever_needed_human(log_of(spark, sf))


@query
def sla_breached(spark, sf):
    return current_of(spark, sf).select("incident_id", "sla_due", "sla_breached")


@query
def human_transition(spark, sf):
    log, _ = human(spark, sf)
    return log


@query
def human_columns(spark, sf):
    return incident_of(spark, sf).select("incident_id", "assignee", "manual_action", "resolution_notes")


@query
def incident_lookup(spark, sf):
    return shown(store.incident_lookup(current_of(spark, sf), "1001"))


@query
def timeline_delta(spark, sf):
    return timelines(log_of(spark, sf))


@query
def format_delta(spark, sf):
    """Every document's length as a gap in ms, scaled so that all units occur."""
    docs = tables.read(spark, sf, "documents")
    gap = F.col("n_chars") * F.when(F.col("doc_id") % 3 == 0, 1).when(F.col("doc_id") % 3 == 1, 100).otherwise(40000)
    return docs.select("doc_id", gap.alias("ms"), text.delta_label(gap).alias("delta"))


def _view(name: str) -> Query:
    return lambda spark, sf: shown(views.worklist(current_of(configure(spark), sf), name))


for _name in ("attention", "open", "breached", "all"):
    QUERIES[f"view_{_name}"] = _view(_name)


@query
def view_counts(spark, sf):
    return views.view_counts(current_of(spark, sf))


@query
def inspect_triage(spark, sf):
    return shown(orders_of(spark, sf)).select(
        "priority", "queue", "asset_id", "doc_ref", "matched_section", "score", "match_confidence", "sla_due")


# ---- dashboards -------------------------------------------------------------------------------

@query
def dash_last_hour(spark, sf):
    ctx, act = families(stage_one(spark, sf))
    _, hum = human(spark, sf)
    recent = store.incidents_between(
        ctx, act, hum, "created_at", moment(AS_OF) - F.expr("INTERVAL 1 HOUR"), moment(AS_OF))
    return metrics.last_hour(recent, moment(AS_OF))


@query
def dash_needs_human(spark, sf):
    return metrics.needs_human(current_of(spark, sf))


@query
def dash_sla_breached(spark, sf):
    return metrics.breached(current_of(spark, sf))


def _percentile(p: float, since: Callable[[], tuple[Column, Column]]) -> Query:
    def run(spark, sf):
        found = metrics.latency_percentile(incident_of(configure(spark), sf), p, *since())
        return found.select(F.round("value", 6).alias("value"))
    return run


def _before_all() -> tuple[Column, Column]:
    return moment("2023-01-01 00:00:00"), moment("2023-01-02 00:00:00")


QUERIES["dash_p50"], QUERIES["dash_p95"] = _percentile(0.5, lambda: last("15 MINUTES")), _percentile(0.95, lambda: last("15 MINUTES"))
QUERIES["dash_p95_range"], QUERIES["dash_p50_quiet"] = _percentile(0.95, panel_range), _percentile(0.5, _before_all)


@query
def dash_grounded_pct(spark, sf):
    return metrics.grounded_pct(current_of(spark, sf), *last("1 HOUR"))


@query
def dash_latency_series(spark, sf):
    series = metrics.latency_series(incident_of(spark, sf), *panel_range())
    return series.select("minute", *[F.round(c, 6).alias(c) for c in ("retrieval_ms", "planning_ms", "total_ms")])


@query
def dash_time_split(spark, sf):
    return metrics.time_split(incident_of(spark, sf), *panel_range())


@query
def dash_status_pie(spark, sf):
    return metrics.status_pie(current_of(spark, sf), *panel_range())


@query
def dash_priority_by_queue(spark, sf):
    return metrics.priority_by_queue(incident_of(spark, sf), *panel_range())


@query
def dash_confidence(spark, sf):
    return metrics.confidence(incident_of(spark, sf), *panel_range())


@query
def dash_top_sections(spark, sf):
    return metrics.top_sections(incident_of(spark, sf), *panel_range())


@query
def dash_waiting(spark, sf):
    return views.waiting(current_of(spark, sf))


@query
def sum_status(spark, sf):
    return metrics.by_status(current_of(spark, sf))


@query
def sum_human_rate(spark, sf):
    return metrics.human_rate(current_of(spark, sf))


@query
def sum_latency(spark, sf):
    return metrics.latency_summary(incident_of(spark, sf))


# ---- audit ------------------------------------------------------------------------------------

def audited(spark, sf) -> DataFrame:
    return audits.audit(orders_of(spark, sf), audits.ground_truth(spark, tables.EXPECTED))


@query
def audit_rows(spark, sf):
    return audited(spark, sf).select(
        "alarm_id", "fault_code", "doc_ref", "expected", score6(), "correct", "result")


@query
def audit_summary(spark, sf):
    found = audits.audit_summary(audited(spark, sf))
    return found.select("correct", "total", "covered", "uncovered",
                        *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("min_score", "max_score")])


@query
def audit_exhaustive(spark, sf):
    ranges = audits.score_ranges(audits.audit(retrieve.context(spark, sf), audits.ground_truth(spark, tables.EXPECTED)))
    return ranges.select("covered", "alarms", "correct",
                         *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("min_score", "max_score")])


@query
def calibrate_threshold(spark, sf):
    return audits.calibrate(audited(spark, sf)).select(
        F.round(F.col("cut").cast("double"), 6).alias("cut"), "caught", "flagged")


# ---- streams ----------------------------------------------------------------------------------

def alarm_stream(spark, sf) -> DataFrame:
    """The events table as an unbounded source."""
    declared = tables.read(spark, sf, "events").schema
    events = spark.readStream.schema(declared).option("pathGlobFilter", "events.parquet").parquet(sf)
    return tables.alarms_from(events, F.lit(tables.read(spark, sf, "embeddings").count()))


def finish(started) -> None:
    started.awaitTermination()


def run_retrieve(spark, sf, work: str) -> DataFrame:
    def embed(alarms):
        return lookup(alarms, tables.probes(spark, sf), "probe_id", "left")
    clock = plus_millis(F.col("alarm_time"), 300 + F.col("alarm_id").cast("long") % 700)
    finish(stages.start_retrieve(alarm_stream(spark, sf), tables.manual(spark, sf), embed, f"{work}/context",
                                 f"{work}/checkpoints/retrieve", high=tables.HIGH, medium=tables.MEDIUM, clock=clock))
    return streams.replay_folder(spark, f"{work}/context", streams.CONTEXT)


def run_plan(spark, work: str) -> DataFrame:
    ctx = streams.contexts(streams.folder(spark, f"{work}/context"))
    id_ = F.col("alarm_id").cast("long")
    clock = plus_millis(F.col("t_alarm"), 1300 + id_ % 700 + id_ % 1500)
    orders = stages.plan(ctx, QUOTING, clock=clock)
    finish(sinks.to_folder(orders, f"{work}/orders", f"{work}/checkpoints/plan"))
    return streams.replay_folder(spark, f"{work}/orders", WORK_ORDER)


def run_incidents(spark, work: str, incidents: int = 0) -> DataFrame:
    """``incidents``: as many are expected. Beyond a bound their ids do not stay in memory."""
    if incidents > state.IN_MEMORY:
        state.use_state_store(spark)
    ctx = stages.first_context(streams.contexts(streams.folder(spark, f"{work}/context")), F.col("t_context"))
    act = stages.first_action(streams.work_orders(streams.folder(spark, f"{work}/orders")))
    finish(sinks.to_folder(ctx, f"{work}/ctx", f"{work}/checkpoints/ctx", form="parquet"))
    finish(sinks.to_folder(act, f"{work}/act", f"{work}/checkpoints/act", form="parquet"))
    return store.merge_incidents(spark.read.parquet(f"{work}/ctx"), spark.read.parquet(f"{work}/act"))


def run_status(spark, sf, work: str) -> DataFrame:
    rows = stages.status_rows(alarm_stream(spark, sf),
                              streams.contexts(streams.folder(spark, f"{work}/context")),
                              streams.work_orders(streams.folder(spark, f"{work}/orders")))
    finish(sinks.to_folder(rows, f"{work}/log", f"{work}/checkpoints/status", form="parquet"))
    return spark.read.parquet(f"{work}/log")


@query
def stream_context(spark, sf):
    """Stage 1 as a stream into a folder of JSON records, read back."""
    ctx = run_retrieve(spark, sf, run_dir(spark, "context"))
    return ctx.withColumn("score", score6()).withColumn("planner_input", F.md5("planner_input"))


@query
def stream_orders(spark, sf):
    """Stages 1 and 2, each its own streaming query."""
    work = run_dir(spark, "orders")
    run_retrieve(spark, sf, work)
    return run_plan(spark, work).select("alarm_id", "doc_ref", "priority", score6(), "t_action", "ai_work_order")


@query
def stream_incident(spark, sf):
    """Stages 1, 2 and 3."""
    work = run_dir(spark, "incident")
    run_retrieve(spark, sf, work)
    run_plan(spark, work)
    return run_incidents(spark, work, tables.read(spark, sf, "events").count()).select(
        "incident_id", "priority", "queue", "created_at", "retrieval_lag_ms", "planning_lag_ms", "total_lag_ms")


@query
def stream_status(spark, sf):
    """Stages 1, 2 and 4."""
    work = run_dir(spark, "status")
    run_retrieve(spark, sf, work)
    run_plan(spark, work)
    return run_status(spark, sf, work)


def as_stream(spark, rows: DataFrame, path: str) -> DataFrame:
    """A table as a stream of files."""
    rows.write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def state_buckets(spark, sf) -> int:
    """An alarm is an incident."""
    return state.buckets_for(tables.read(spark, sf, "events").count())


def finish_rows(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All rows that a stateful stream gives out, from a stored table."""
    finish(sinks.each_batch(rows, lambda batch: {path: batch}, checkpoint, mode="update", keep=False))
    return sinks.read_batches(rows.sparkSession, path)


@query
def stream_incident_current(spark, sf):
    """The current state from the change feed of keyed state."""
    state.use_state_store(spark)
    work = run_dir(spark, "feed")
    ctx = stage_one(spark, sf)
    rows = state.changes(*families(ctx), human(spark, sf)[1], log_of(spark, sf, ctx))
    changed = state.change_feed(as_stream(spark, rows, f"{work}/in"), buckets=state_buckets(spark, sf))
    feed = finish_rows(changed, f"{work}/feed", f"{work}/checkpoint")
    return shown(state.current(feed, moment(AS_OF)))


@query
def stream_sla_breached(spark, sf):
    """Incidents that are late at the moment asked about, from the events of their deadlines. A record a year later
    stands for the stream going on, so that the watermark passes that moment."""
    state.use_state_store(spark)
    work = run_dir(spark, "deadlines")
    ctx = stage_one(spark, sf)
    stamps = ctx.select(F.col("alarm_id").alias("incident_id"), "t_context", "sla_due")
    later = spark.createDataFrame([("later", None)], "incident_id STRING, sla_due TIMESTAMP_NTZ").select(
        "incident_id", (moment(AS_OF) + F.expr("INTERVAL 1 YEAR")).alias("t_context"), "sla_due")
    flags = finish_rows(state.breaches(as_stream(spark, stamps.unionByName(later), f"{work}/ctx"),
                                       as_stream(spark, log_of(spark, sf, ctx), f"{work}/log"),
                                       buckets=state_buckets(spark, sf)),
                        f"{work}/flags", f"{work}/checkpoint")
    return state.breached_at(flags, moment(AS_OF)).where("sla_breached").select("incident_id")


@query
def stream_human_actions(spark, sf):
    """Human actions as a stream with two outputs; the log it leaves."""
    work = run_dir(spark, "actions")
    tables.actions(spark, sf).write.parquet(f"{work}/in")
    source = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    finish(stages.human_actions(source, f"{work}/log", f"{work}/hum", f"{work}/checkpoints/actions"))
    return sinks.read_batches(spark, f"{work}/log")
