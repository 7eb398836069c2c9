"""Gaps between the statuses of each incident."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.clock import millis_between
from faultline.functions.text import delta_label


def timelines(log: DataFrame, bucket: str = "hour") -> DataFrame:
    """Status rows of every incident with the gap since the previous one; the first has none.

    One incident may own a large share of the log, so no window spans a whole incident: rows are
    ordered within (incident, time bucket), and the last row of each bucket is carried into the
    incident's next bucket that has rows. The carried rows are one per bucket and are found by an
    aggregation that combines before its shuffle.
    """
    rows = log.withColumn("__bucket", F.date_trunc(bucket, "at_ts"))
    ends = rows.groupBy("incident_id", "__bucket").agg(F.max(F.struct("at_ts", "seq")).alias("end"))
    per_incident = Window.partitionBy("incident_id").orderBy("__bucket")
    carried = ends.select(
        "incident_id", F.lead("__bucket").over(per_incident).alias("__bucket"),
        F.col("end.at_ts").alias("at_ts"), F.col("end.seq").alias("seq"),
        F.lit(True).alias("__carried")).where(F.col("__bucket").isNotNull())
    both = rows.withColumn("__carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    within = Window.partitionBy("incident_id", "__bucket").orderBy("at_ts", "seq")
    gaps = both.withColumn("delta_ms", millis_between(F.lag("at_ts").over(within), F.col("at_ts")))
    return gaps.where(~F.col("__carried")).drop("__bucket", "__carried").withColumn(
        "delta", delta_label(F.col("delta_ms")))
