"""Checks and jobs on the corpus before it is searched."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: what a reading is called, by keyword of the failure mode --------------------
# The first rule with a keyword contained in the text decides: (keywords, unit, low, high, verb)
MODE_RULES = [
    (("wear", "backlash", "elongation", "misalignment", "sag", "scoring", "fretting", "alignment",
      "index error", "overshoot", "seating error", "dead zone"), "mm", 0.02, 0.9, "exceeds"),
    (("pitting", "roughness", "flat spotting", "degradation", "looseness"), "mm/s RMS", 2.8, 9.5, "rises above"),
    (("grip loss", "slippage", "slip", "tension loss", "creep", "drift"), "Nm", 25.0, 220.0, "falls below"),
    (("leak", "weep", "bypass", "leak-back", "oil leak", "excess flow", "leakage"), "ml/min", 5.0, 90.0, "exceeds"),
    (("pressure loss", "precharge loss", "setpoint drift", "hysteresis", "null shift", "chatter", "sticking",
      "imbalance"), "bar", 3.0, 240.0, "falls below"),
    (("overheating", "temperature rise", "dew point rise", "temperature swing", "zone imbalance", "cooling loss"),
     "degrees C", -20.0, 190.0, "climbs past"),
    (("insulation degradation", "high impedance", "ingress"), "megohm", 1.0, 60.0, "falls below"),
    (("overcurrent", "ripple", "hot joint", "output droop", "saturation", "electrical erosion"),
     "A", 2.0, 180.0, "exceeds"),
    (("phase error", "intermittent output", "CRC errors", "channel failure", "contact bounce", "ground loop",
      "loose connection", "welded contacts"), "mV", 8.0, 400.0, "exceeds"),
    (("slow shift", "asynchrony", "cross fault", "diagnostic fault", "muting fault", "false trip",
      "slow to extend"), "ms", 40.0, 480.0, "exceeds"),
    (("flow restriction", "restriction", "blockage", "loss of vacuum", "flow loss", "clogging", "fouling",
      "scaling", "contamination", "aeration", "condensate build-up", "bowl contamination", "cushion loss"),
     "l/min", 3.0, 90.0, "drops under"),
    (("open circuit",), "megohm", 5.0, 90.0, "exceeds"),
    (("bearing failure",), "mm/s RMS", 3.2, 11.0, "rises above"),
    (("icing",), "degrees C", -18.0, 2.0, "falls below"),
]
CATEGORY_RULES = {
    "mechanical": ("mm", 0.02, 0.40, "exceeds"),
    "hydraulic": ("bar", 60.0, 240.0, "falls below"),
    "electrical": ("V", 12.0, 640.0, "sags below"),
    "thermal": ("degrees C", 35.0, 190.0, "climbs past"),
    "safety": ("ms", 40.0, 480.0, "exceeds"),
    "pneumatic": ("bar", 3.0, 11.0, "falls below"),
}
# ---- fixed values: topics the corpus must leave uncovered, and the pairs its curated part owns ------
UNCOVERED_TOPICS = ("crane", "scanner", "fume extraction", "guard hinge", "lockout point")
CURATED_PAIRS = [
    ("spindle", "bearing wear"), ("hydraulic system", "pressure loss"), ("servo drive", "overcurrent"),
    ("encoder", "signal loss"), ("coolant", "high temperature"), ("chiller", "condenser fouling"),
    ("guard interlock", "fails to close"), ("compressed air", "moisture carryover"),
    ("tool changer", "misalignment"), ("conveyor belt", "tracking"), ("linear guides", "lubrication"),
    ("hydraulic oil", "contamination"), ("emergency stop circuit", "will not reset"),
    ("pneumatic actuator", "slow to extend"),
]
PART_NUMBER = r"[A-Z]{2}-[0-9]+"


def contains_any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def measure_for(text: Column, category: Column, rules=None, fallback=None) -> Column:
    """struct<rule_no, unit, low, high, verb>: the first matching rule, else the category's.

    Order decides between overlapping keywords. ``rule_no`` is NULL for a fallback; a category
    without one gives NULL.
    """
    def outcome(number, values):
        unit, low, high, verb = values
        return F.struct(F.lit(number).cast("int").alias("rule_no"), F.lit(unit).alias("unit"),
                        F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(verb).alias("verb"))
    chain = F
    for number, (words, *values) in enumerate(MODE_RULES if rules is None else rules):
        chain = chain.when(contains_any(text, words), outcome(number, values))
    for name, values in (CATEGORY_RULES if fallback is None else fallback).items():
        chain = chain.when(category == name, outcome(None, values))
    return chain


class KeywordRules:
    """First-match rules of any number of keywords: one pass over a text, however many there are.

    ``rules`` holds ``rule_no`` (the smaller counts first) and ``word``; rows without either are ignored, an empty word
    stands in every text. The keywords become one automaton, built once per task and dropped with it. They have to fit
    ``most_bytes``, which is checked: they are shipped with every task.
    """

    def __init__(self, rules: DataFrame, most_bytes: int = 64 << 20):
        known = rules.where("rule_no IS NOT NULL AND word IS NOT NULL").groupBy("word").agg(F.min("rule_no").alias("rule_no"))
        size = known.agg(F.coalesce(F.sum(F.octet_length("word") + 16), F.lit(0)).alias("bytes")).first().bytes
        if size > most_bytes:
            raise ValueError(f"keywords take {size} bytes, over the bound of {most_bytes}")
        self.words = [(r.word, r.rule_no) for r in known.collect()]

    def first(self, text: Column) -> Column:
        """The number of the first rule with a keyword contained in ``text``; NULL without one, and for a NULL text."""
        words = [(w, n) for w, n in self.words if w]
        always = min((n for w, n in self.words if not w), default=None)
        least = min((n for _, n in self.words), default=None)

        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            import ahocorasick
            automaton = ahocorasick.Automaton()
            for word, number in words:
                automaton.add_word(word, number)
            automaton.make_automaton()

            def best(value: str) -> int | None:
                found = always
                if words:
                    for _, number in automaton.iter(value):
                        if found is None or number < found:
                            found = number
                            if found == least:
                                break
                return found

            for batch in batches:
                yield pa.array([None if v is None else best(v) for v in batch.to_pylist()], pa.int32())

        scan.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(scan, returnType="int")(text)


def repeated(df: DataFrame, key: Column | str) -> DataFrame:
    """Values of ``key`` on more than one row; counts are combined before the shuffle."""
    column = F.col(key) if isinstance(key, str) else key
    return df.groupBy(column.alias("value")).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def part_numbers(df: DataFrame, text: str = "content") -> DataFrame:
    """One row per mention of a part number, over the whole text."""
    return df.withColumn("part", F.explode(F.regexp_extract_all(F.col(text), F.lit(PART_NUMBER), F.lit(0))))


def uniqueness(df: DataFrame) -> DataFrame:
    """Repeated references, titles and part numbers of a corpus, in one list.

    A part number counts once per section that names it.
    """
    parts = part_numbers(df).select("id", "part").distinct()
    keyed = [("doc_ref", repeated(df, "doc_ref")), ("section", repeated(df, "section")),
             ("part", repeated(parts, "part"))]
    return reduce(lambda a, b: a.unionByName(b), [r.select(F.lit(n).alias("what"), "value", "n") for n, r in keyed])


def exclude(candidates: DataFrame, component: str, mode: str, curated: DataFrame | None = None,
            topics=UNCOVERED_TOPICS) -> DataFrame:
    """Candidates that neither restate a curated pair nor touch an uncovered topic."""
    if curated is None:
        curated = candidates.sparkSession.createDataFrame(CURATED_PAIRS, f"{component} STRING, {mode} STRING")
    allowed = candidates.where(~contains_any(F.col(component), topics)) if topics else candidates
    return allowed.join(curated.select(component, mode).distinct(), [component, mode], "left_anti")


def category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.count("*").alias("sections"))


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``id`` = 0..n-1 in the given order, without sorting everything in one task.

    Rows are range-partitioned by the order; each partition's count (one row each) gives the offset of
    the next. The order has to be unique per row for ids to be reproducible.
    """
    ordered = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ordered = ordered.checkpoint()  # numbering must see the very partitions it counted
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("__part").agg(F.count("*").alias("n"))
    starts = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    numbered = ordered.join(F.broadcast(starts), "__part")  # one row per shuffle partition
    return numbered.withColumn("id", F.col("__start") + nth - 1).drop("__part", "__start")
