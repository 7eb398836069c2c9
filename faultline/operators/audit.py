"""Retrieval against ground truth, and the confidence cut that separates best."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.operators.joins import lookup
from faultline.session import materialize

BINS = 4096

# ---- fixed values: section expected for each fault code; None where the manual covers nothing ----
EXPECTED_SECTIONS = {
    "VIB-HIGH": "SM-4.3", "HYD-LOW": "SM-5.1", "E-217": "SM-6.2", "ENC-LOSS": "SM-6.5", "COOL-HOT": "SM-7.1",
    "CHILL-CYC": "SM-7.4", "GUARD-OPEN": "SM-8.1", "AIR-WET": "SM-10.1", "TOOL-MISS": "SM-9.2",
    "BELT-TRACK": "SM-9.6", "CRANE-PENDANT": None, "FIRE-DOOR": None, "EXTRACT-FAN": None,
    "SCANNER-DROP": None, "RAIL-DAMAGE": None,
}


def ground_truth(spark: SparkSession, expected: dict[str, str | None] | None = None) -> DataFrame:
    """Mapping table (fault_code, expected) for ``audit``."""
    pairs = list((EXPECTED_SECTIONS if expected is None else expected).items())
    return spark.createDataFrame(pairs, "fault_code STRING, expected STRING")


def audit(orders: DataFrame, mapping: DataFrame) -> DataFrame:
    """Verdict per order.

    Covered fault: right when the expected section came back. Uncovered fault (expected NULL): right
    when confidence is low. A code that the mapping does not know expects ``?``, so it is a miss.
    """
    known = mapping.withColumn("__known", F.lit(True))
    expected = F.when(F.col("__known"), F.col("expected")).otherwise("?")
    judged = lookup(orders, known, "fault_code", "left").withColumn("expected", expected)
    covered = F.col("expected").isNotNull()
    ok = F.when(covered, F.col("expected").eqNullSafe(F.col("doc_ref"))).otherwise(
        F.col("match_confidence").eqNullSafe("low"))
    miss = F.when(covered, "MISMATCH").otherwise(
        F.concat(F.lit("SCORED "), F.coalesce("match_confidence", F.lit("")), F.lit(", WANTED low")))
    return judged.select(
        *orders.columns, "expected", covered.alias("covered"), ok.alias("correct"),
        F.when(ok, "ok").otherwise(miss).alias("result"))


def audit_summary(audited: DataFrame) -> DataFrame:
    return audited.agg(
        F.count_if("correct").alias("correct"), F.count("*").alias("total"),
        F.count_if("covered").alias("covered"), F.count_if(~F.col("covered")).alias("uncovered"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def score_ranges(audited: DataFrame) -> DataFrame:
    """Score range and accuracy of covered and uncovered alarms."""
    return audited.groupBy("covered").agg(
        F.count("*").alias("alarms"), F.count_if("correct").alias("correct"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def calibrate(audited: DataFrame) -> DataFrame:
    """The single cut such that scores below it are called low.

    Candidates are the distinct scores. Most uncovered alarms caught comes first, then fewest covered
    ones flagged, then the lowest cut. Counts below a cut accumulate in two levels, over a fixed number of bins of the
    measured range (any metric) and inside each bin, so no task sees all scores. The counts are stored: what lies before
    them runs once, not for the range's ends again.
    """
    per_score = materialize(audited.where(F.col("score").isNotNull()).groupBy("score").agg(
        F.count_if(~F.col("covered")).alias("u"), F.count_if("covered").alias("c")), "scores")
    low, high = per_score.agg(F.min("score")).scalar(), per_score.agg(F.max("score")).scalar()
    binned = per_score.withColumn("bin", F.floor(
        (F.col("score") - low) * F.lit(float(BINS)) / F.when(high > low, high - low).otherwise(F.lit(1.0))))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("bin").agg(F.sum("u").alias("bu"), F.sum("c").alias("bc"))
    bins = bins.select(  # at most BINS + 1 rows in this window and in this broadcast
        "bin", F.coalesce(F.sum("bu").over(before), F.lit(0)).alias("u0"),
        F.coalesce(F.sum("bc").over(before), F.lit(0)).alias("c0"))
    inside = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    cuts = binned.join(F.broadcast(bins), "bin").select(
        F.col("score").alias("cut"),
        (F.col("u0") + F.coalesce(F.sum("u").over(inside), F.lit(0))).alias("caught"),
        (F.col("c0") + F.coalesce(F.sum("c").over(inside), F.lit(0))).alias("flagged"))
    best = F.max(F.struct("caught", (-F.col("flagged")).alias("f"), (-F.col("cut")).alias("x"), "flagged", "cut"))
    return cuts.agg(best.alias("b")).select("b.cut", "b.caught", "b.flagged")
