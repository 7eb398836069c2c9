"""Join of a large side to a side with one row, or a few, per key; one key of it may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner",
           salts: int = 1, spread: Column | None = None) -> DataFrame:
    """``facts`` joined to ``dim`` on ``key``; ``facts`` is on the left.

    With ``salts=1`` a hot key is left to adaptive execution, which splits its oversized shuffle
    partition (for a left join also that of the NULL key) and re-reads only the matching part of
    ``dim``: wide rows are not repeated for keys that are not hot. ``salts=n`` cuts every key into
    ``n`` shares up front, by a hash of ``spread`` (an id of the fact row), and repeats ``dim`` as
    often: for narrow dimensions, or where adaptive execution does not apply. Nothing is broadcast
    by hint; the planner and adaptive execution decide from sizes.
    """
    if salts == 1:
        return facts.join(dim, key, how)
    left = facts.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"], how).drop("__salt")
