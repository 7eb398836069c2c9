"""First-match rules through an automaton, against plain containment."""

import random
import time

import pytest
from pyspark.sql import functions as F

from faultline.operators.corpus import MODE_RULES, KeywordRules, measure_for


def rules_of(spark, pairs):
    return spark.createDataFrame(pairs, "rule_no INT, word STRING")


def test_equals_plain_containment(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(40), "".join(rng.choices("abé", k=rng.randint(1, 5)))) for _ in range(120)] + [(7, "a b"), (None, "x"), (3, None)]
    texts = [(n, "".join(rng.choices("abé cd", k=rng.randint(0, 12)))) for n in range(300)] + [(900, None), (901, "")]
    got = {r.id: r.rule for r in spark.createDataFrame(texts, "id INT, t STRING").repartition(4).select(
        "id", KeywordRules(rules_of(spark, pairs)).first(F.col("t")).alias("rule")).collect()}
    held = [(n, w) for n, w in pairs if n is not None and w is not None]
    assert got == {i: None if t is None else min((n for n, w in held if w in t), default=None) for i, t in texts}


def test_equals_the_column_chain(spark):
    pairs = [(n, w) for n, rule in enumerate(MODE_RULES) for w in rule[0]]
    texts = [(n, f"the {a} {b} reading") for n, (a, b) in enumerate(zip([w for _, w in pairs], reversed([w for _, w in pairs])))]
    df = spark.createDataFrame([*texts, (999, "nothing of the kind")], "id INT, t STRING")
    both = df.select(KeywordRules(rules_of(spark, pairs)).first(F.col("t")).alias("a"),
                     measure_for(F.col("t"), F.lit("none"))["rule_no"].alias("b")).collect()
    assert all(r.a == r.b for r in both) and {r.a for r in both} > {0, 5, None}


def test_empty_word_no_rules_and_bound(spark):
    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, None)], "id INT, t STRING")

    def first(pairs):
        return [r.n for r in df.orderBy("id").select(KeywordRules(rules_of(spark, pairs)).first(F.col("t")).alias("n")).collect()]

    assert first([(5, ""), (2, "b")]) == [2, 5, None]
    assert first([]) == [None, None, None]
    with pytest.raises(ValueError):
        KeywordRules(rules_of(spark, [(1, "long word")]), most_bytes=10)


def test_many_keywords_cost_about_as_much_as_few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").repartition(8).cache()
    docs.count()

    def seconds(count):
        rng = random.Random(count)
        pairs = [(n, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))) for n in range(count)]
        column = KeywordRules(rules_of(spark, pairs)).first(F.col("text"))
        best = []
        for _ in range(3):
            began = time.perf_counter()
            docs.select(column.alias("n")).agg(F.count("n")).collect()
            best.append(time.perf_counter() - began)
        return min(best)

    seconds(10)
    few, many = seconds(100), seconds(10_000)
    docs.unpersist()
    assert many < 3 * few + 1.5
