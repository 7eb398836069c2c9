"""Secret scans through an incremental ledger of blobs. Only DataFrame and SQL functions are used.

The content of every version of every path is addressed by its SHA-256. The ledger is a Parquet folder with one row per
(blob, rule, version of the rule) that was ever scanned, and the spans found, none included. ``scan`` addresses the
versions it is given, scans the blobs that lack a row for some rule in its present version, for those rules only, appends
what it found, and joins the ledger back to all versions of all paths. A second run over the same history reads no text
beyond addressing; a new rule version scans every blob once for that rule.

A rule is a pattern, the group whose length counts, and the least length. Matches are leftmost and do not overlap; those
that are too short are dropped after matching. Positions are code points: the pieces between matches and the matches
themselves are measured and summed up.

Cases: a NULL text is the empty blob, which has no spans; copies share a blob and are scanned once, also when a third of
all versions is one blob (its text meets partial aggregation before any shuffle); repeated rows get the spans each; an
empty table gives an empty result; a NULL path keeps its row; texts of any length are scanned whole; extra columns are
kept, whatever their names, except those of the result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import run_dir


@dataclass(frozen=True)
class Rule:
    """``hint`` is a cheaper pattern that every blob with a match of ``pattern`` has a match of."""

    name: str
    pattern: str
    group: int
    least: int
    hint: str
    version: int = 1


#: Base rules in the order in which kinds are listed (patterns are fixed values).
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         r"""(?i:passw(?:or)?d|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
)
#: Rules beyond the base ones.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, r"-----BEGIN [A-Z ]*PRIVATE KEY"),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]+", 0, 40, r"gh[pousr]_[A-Za-z0-9]{36}"),
)
RULES = BASE + MORE
#: A private key from its header to its END line or, where that is missing, to the end of the base64 block: tokens of 16
#: characters or more, then a shorter last one that ends its line. All loops are possessive, so long keys take no stack.
KEY = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-{5,}+END [A-Z ]*PRIVATE KEY-----"
       r"|(?:(?:\s|\\[nrt]|[>#*\"',])*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
       r"(?:(?:\s|\\[nrt]|[>#*\"',])*+(?<![A-Za-z0-9+/_])(?:[A-Za-z0-9+/_]|-(?!-)){16,}+={0,2}+)*+"
       r"(?:(?<=[A-Za-z0-9+/_=-]{16})(?:[\x20\t>#*\"',]|\\[nrt]|\r|\n)++[A-Za-z0-9+/_]++(?:={1,2}+|(?=\x20*+(?:[\r\n\"'\\]|\z))))?)")
#: What masking takes; the rules of the report are fixed by its SQL, where a key is found by its header.
MASKED = tuple(Rule("pem", KEY, 0, 1, r.hint, version=2) if r.name == "pem" else r for r in RULES)
LEDGER = ("blob string, rule string, version int, spans array<struct<start: int, kind: int, name: string, end: int>>")


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Spans of one rule in ``text``: structs that sort by start, then kind."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)
    zipped = F.zip_with(F.zip_with(between, found, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))),
                        counted, lambda pair, part: F.struct(
                            F.length(pair["gap"]).alias("gap"), F.length(pair["hit"]).alias("hit"),
                            F.length(part).alias("part")))
    pieces = F.filter(zipped, lambda p: p["hit"].isNotNull())
    kind = "struct<start: int, kind: int, name: string, end: int>"

    def add(state, piece):
        start = state["at"] + piece["gap"]
        end = start + piece["hit"]
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("kind"), F.lit(rule.name).alias("name"),
                                end.alias("end")).cast(kind))
        spans = F.when(piece["part"] >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("spans"))
    return F.when(text.rlike(rule.hint), F.aggregate(pieces, start, add, lambda state: state["spans"])).otherwise(
        F.array().cast(f"array<{kind}>"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger so far, or None when the folder does not exist yet."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan(versions: DataFrame, ledger: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with ``blob`` and ``found`` (all spans, sorted), scanned through the ledger folder ``ledger``."""
    spark = versions.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(F.sha2(body, 256).alias("blob"), body.alias("text"))
    wanted = spark.createDataFrame([(r.name, r.version) for r in rules], "rule string, version int")
    known = read_ledger(spark, ledger)
    if known is not None:
        # one row per blob: the rules that it was already scanned for, in their present versions
        done = known.join(F.broadcast(wanted), ["rule", "version"], "left_semi").groupBy("blob").agg(
            F.collect_set("rule").alias("done"))
        blobs = blobs.join(done, "blob", "left").filter(
            F.coalesce(F.array_size("done"), F.lit(0)) < len(rules))
    else:
        blobs = blobs.withColumn("done", F.lit(None).cast("array<string>"))
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"), F.first("done").alias("done"))
    jobs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                              spans_of(F.col("text"), r, n).alias("spans")) for n, r in enumerate(rules)])
    rows = unseen.select("blob", "done", F.explode(jobs).alias("job")).filter(
        ~F.coalesce(F.array_contains("done", F.col("job.rule")), F.lit(False))).select("blob", "job.*")
    rows.write.mode("append").parquet(ledger)
    now = spark.read.schema(LEDGER).parquet(ledger)
    current = reduce(lambda a, b: a | b, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules])
    found = now.filter(current & (F.array_size("spans") > 0)).groupBy("blob").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("found"))
    paths = versions.withColumn("blob", F.sha2(body, 256))
    return paths.join(found, "blob", "left").withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<start: int, kind: int, name: string, end: int>>")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; spans that overlap or touch are one."""
    body = F.coalesce(text, F.lit(""))

    def add(state, span):
        fresh = span["start"] > state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], F.when(fresh, F.concat(
                F.substring(body, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))).otherwise(
                    F.when((state["at"] == 0) & (span["start"] == 0) & (F.length(state["out"]) == 0), F.lit(mark))
                    .otherwise(F.lit("")))).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.array_size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, add, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body)))))


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document the counts of base kinds, the digest of base spans, and all spans."""
    spark = docs.sparkSession
    rows = scan(docs.select("doc_id", "text"), ledger or run_dir(spark, "ledger"))
    base = F.filter("found", lambda s: s["kind"] < len(BASE))

    def count(number: int, rule: Rule) -> Column:
        return F.array_size(F.filter("found", lambda s: s["kind"] == number)).cast("long").alias(f"n_{rule.name}")

    counts = [count(n, r) for n, r in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                       listed(F.col("found")).alias("spans"))


def kind_sql(rule: Rule, number: int) -> str:
    """DuckDB: the spans of one rule as a list of structs."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
      SELECT doc_id, {number} AS kind, '{rule.name}' AS name, start, start + hit AS finish FROM (
        SELECT doc_id, hit, part, coalesce(sum(gap + hit) OVER w, 0) + gap AS start FROM (
          SELECT doc_id, n, length(gaps[n]) AS gap, length(hits[n]) AS hit, length(parts[n]) AS part FROM (
            SELECT doc_id, gaps, hits, parts, unnest(range(1, len(hits) + 1)) AS n FROM (
              SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS hits,
                     regexp_extract_all(text, '{pattern}', {rule.group}) AS parts FROM documents)))
        WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      WHERE part >= {rule.least}"""


SQL = f"""
WITH found AS ({" UNION ALL ".join(kind_sql(r, n) for n, r in enumerate(RULES))}),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex,
               string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind)
                 FILTER (kind < {len(BASE)}) AS base,
               string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind) AS spans
        FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)"""
