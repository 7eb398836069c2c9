"""Dashboard and operations queries. ``as_of`` is their clock; a range is (since, until]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.plans.views import is_open
from faultline.schemas import PRIORITIES
from faultline.session import materialize

BINS = 4096


def within(column: str, since: Column, until: Column) -> Column:
    return (F.col(column) > since) & (F.col(column) <= until)


def _hour_before(as_of: Column) -> Column:
    return as_of - F.expr("INTERVAL 1 HOUR")


def last_hour(incident: DataFrame, as_of: Column) -> DataFrame:
    return incident.where(within("created_at", _hour_before(as_of), as_of)).agg(F.count("*").alias("value"))


def needs_human(current: DataFrame) -> DataFrame:
    return current.where(F.col("needs_human") & is_open()).agg(F.count("*").alias("value"))


def breached(current: DataFrame) -> DataFrame:
    return current.where("sla_breached").agg(F.count("*").alias("value"))


def percentiles(values: DataFrame, column: str, **named: float) -> DataFrame:
    """Exact interpolated percentiles. Equal values are counted first; ranks accumulate over a fixed number of bins of
    the measured range and then inside each bin, so no task sees all values."""
    counted = materialize(values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(
        F.count("*").alias("n")), "counts")  # read three times
    low, high = counted.agg(F.min("v")).scalar(), counted.agg(F.max("v")).scalar()
    binned = counted.withColumn("bin", F.floor((F.col("v") - low) * F.lit(float(BINS)) / F.greatest(high - low, F.lit(1))))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("bin").agg(F.sum("n").alias("bn")).select(  # at most BINS + 1 rows
        "bin", F.coalesce(F.sum("bn").over(upto), F.lit(0)).alias("n0"),
        F.sum("bn").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = binned.join(F.broadcast(bins), "bin").select(
        "v", "n", "total", (F.col("n0") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("first") <= rank) & (rank < F.col("first") + F.col("n")), F.col("v")))

    found = [F.max("total").alias("total")]
    for name, p in named.items():
        place = F.lit(p) * (F.col("total") - 1)
        found += [at(F.floor(place)).alias(f"{name}_low"), at(F.ceil(place)).alias(f"{name}_high")]
    rows = ranked.agg(*found)
    shares = {name: F.lit(p) * (F.col("total") - 1) for name, p in named.items()}
    return rows.select(*[(F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low"))
                          * (place - F.floor(place))).cast("double").alias(name) for name, place in shares.items()])


def latency_percentile(incident: DataFrame, p: float, since: Column, until: Column) -> DataFrame:
    """0 when nothing finished in the range."""
    found = percentiles(incident.where(within("t_action", since, until)), "total_lag_ms", value=p)
    return found.select(F.coalesce("value", F.lit(0.0)).alias("value"))


def grounded_pct(current: DataFrame, since: Column, until: Column) -> DataFrame:
    """Incidents without a flag count in the denominator only."""
    rows = current.where(within("created_at", since, until))
    share = F.lit(100.0) * F.count_if(~F.col("needs_human")) / F.nullif(F.count("*"), F.lit(0))
    return rows.agg(F.round(share).cast("double").alias("value"))


def latency_series(incident: DataFrame, since: Column, until: Column) -> DataFrame:
    return incident.where(within("t_action", since, until)).groupBy(
        F.date_trunc("minute", "t_action").cast("timestamp_ntz").alias("minute")).agg(
        F.avg("retrieval_lag_ms").alias("retrieval_ms"), F.avg("planning_lag_ms").alias("planning_ms"),
        F.avg("total_lag_ms").alias("total_ms")).orderBy("minute")


def time_split(incident: DataFrame, since: Column, until: Column) -> DataFrame:
    return incident.where(within("t_action", since, until)).agg(
        F.round(F.avg("retrieval_lag_ms")).alias("retrieval_ms"),
        F.round(F.avg("planning_lag_ms")).alias("planning_ms"),
        F.round(F.avg("total_lag_ms")).alias("total_ms"), F.max("total_lag_ms").alias("worst_ms"))


def by_status(current: DataFrame) -> DataFrame:
    return current.groupBy("status").agg(F.count("*").alias("incidents")).orderBy(
        F.col("incidents").desc(), F.col("status").asc_nulls_last())


def status_pie(current: DataFrame, since: Column, until: Column) -> DataFrame:
    return by_status(current.where(within("created_at", since, until)))


def priority_by_queue(incident: DataFrame, since: Column, until: Column) -> DataFrame:
    rows = incident.where(within("created_at", since, until) & F.col("queue").isNotNull())
    counts = [F.count_if(F.col("priority") == p).alias(p) for p in PRIORITIES]
    return rows.groupBy("queue").agg(*counts, F.count("*").alias("total")).orderBy(F.col("total").desc(), "queue")


def confidence(incident: DataFrame, since: Column, until: Column) -> DataFrame:
    rows = incident.where(within("created_at", since, until) & F.col("match_confidence").isNotNull())
    return rows.groupBy(F.col("match_confidence").alias("confidence")).agg(
        F.count("*").alias("incidents"), F.round(F.min("score"), 3).alias("worst"),
        F.round(F.avg("score"), 3).alias("average"), F.round(F.max("score"), 3).alias("best")).orderBy(
        F.col("average").desc(), "confidence")


def top_sections(incident: DataFrame, since: Column, until: Column, limit: int = 10) -> DataFrame:
    rows = incident.where(within("created_at", since, until) & F.col("doc_ref").isNotNull())
    return rows.groupBy("doc_ref", F.col("matched_section").alias("section")).agg(
        F.count("*").alias("hits"), F.round(F.avg("score"), 3).alias("avg_score")).orderBy(
        F.col("hits").desc(), "doc_ref").limit(limit)


def human_rate(current: DataFrame) -> DataFrame:
    flagged = F.count_if("needs_human")
    pct = F.round(F.lit(100.0) * flagged / F.nullif(F.count("*"), F.lit(0)), 1)
    return current.agg(flagged.alias("needs_human"), F.count("*").alias("total"), pct.cast("double").alias("pct"))


def latency_summary(incident: DataFrame) -> DataFrame:
    done = incident.where(F.col("total_lag_ms").isNotNull())
    means = done.agg(F.round(F.avg("retrieval_lag_ms")).alias("embed_retrieve_ms"),
                     F.round(F.avg("planning_lag_ms")).alias("planner_ms"))
    spread = percentiles(done, "total_lag_ms", p50=0.5, p95=0.95)
    # one row beside one row
    return means.select("*", *[F.round(spread.select(p).scalar()).cast("int").alias(f"{p}_ms") for p in ("p50", "p95")])
