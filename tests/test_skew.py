"""One key holds most rows: its work has to be split, and nothing may be lost."""

import pytest
from faultline.operators.joins import lookup
from faultline.operators.store import latest_status
from faultline.operators.vector_search import vector_search
from pyspark.sql import functions as F


@pytest.fixture
def small_partitions(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, hot):
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("string")).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(0, 60_000, 1, 8).select("id", key.alias("key"), F.md5(F.col("id").cast("string")).alias("text"))


@pytest.mark.parametrize("hot", ["7", None])
def test_hot_key_is_split_at_run_time(spark, small_partitions, hot):
    dim = spark.range(500).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("x"))
    joined = lookup(facts(spark, hot), dim, "key", "left")
    # every row is looked at, so that the join cannot be pruned away
    total = joined.select(F.xxhash64("id", "text", "x").alias("h"), "x")
    rows = total.collect()
    assert len(rows) == 60_000 and sum(r.x is None for r in rows) == (20_000 if hot is None else 0)
    assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["7", None])
def test_salted_lookup_gives_the_same_rows(spark, hot):
    dim = spark.range(500).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("x"))
    data = facts(spark, hot)
    for how in ("inner", "left"):
        plain, salted = lookup(data, dim, "key", how), lookup(data, dim, "key", how, salts=8, spread=F.col("id"))
        sums = [df.agg(F.count("*"), F.sum(F.xxhash64("id", "key", "x") % 1000)).first() for df in (plain, salted)]
        assert sums[0] == sums[1]


def test_hot_incident_collapses_before_the_shuffle(spark):
    log = facts(spark, "7").select(F.col("key").alias("incident_id"), F.lit("S").alias("status"),
                                   F.timestamp_seconds("id").cast("timestamp_ntz").alias("at_ts"), F.col("id").alias("seq"))
    latest = latest_status(log)
    rows = latest.collect()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 500 and "partial_max" in plan


def test_search_with_one_vector_on_a_third_of_both_sides(spark):
    def vectors(n, name, key):
        hot = F.array(*[F.lit(float(i)) for i in (1, 2, 3, 4)])
        cold = F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(4)])
        return spark.range(0, n, 1, 4).select(
            F.col("id").alias(key), F.when(F.col("id") % 3 == 0, hot).otherwise(cold).cast("array<float>").alias(name))
    probes, corpus = vectors(3000, "v", "pid"), vectors(6000, "vec", "id")
    results = []
    for strategy in ("resident", "blocked"):
        hits = vector_search(probes, corpus, "v", "vec", k=3, key="pid", strategy=strategy, payload=["id"],
                             smallest_tile=700, tile_bytes=700 * 16)
        results.append(sorted((r.pid, r.rank, r.id, r.score) for r in hits.collect()))
    assert results[0] == results[1] and len(results[0]) == 9000
    assert [r[2] for r in results[0] if r[0] == 3] == [0, 3, 6]
