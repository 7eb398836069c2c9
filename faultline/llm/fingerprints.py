"""Document fingerprints by winnowing, and how alike neighbours in id order are.

Every k-gram of code points gets a rolling polynomial hash (built by doubling, so that a text of any length costs log k
passes), mixed so that small values are random. Of each window of ``WINDOW`` neighbouring grams the smallest value is
chosen, of equal ones the rightmost; a gram chosen by several windows is kept once, with its position. Any passage of at
least ``WINDOW + K - 1`` code points that two texts share leaves a common value in both fingerprints. A text with fewer
grams than a window is one window; a text shorter than a gram is one gram; the empty text has the empty fingerprint.

A fingerprint is a string of ``value:position`` (both hexadecimal, 40 bits of value) joined by commas. The likeness of two
fingerprints is the share of common values among all values of both; two empty ones are alike (1).

``neighbours(docs)`` walks documents in id order. They are dealt into ranges of the id, in one shuffle; the first document
of a range also goes to the range before it (the very first one to the last), so that every document meets its
successor and no range waits for another.

Cases: a NULL text is the empty text; rows with a NULL id come last; rows with equal ids follow each other in order of
their texts; a single document is its own successor; an empty table gives an empty result; a very long text is hashed
in blocks; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, WINDOW = 12, 24
POSITION_BITS = 24
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def times(a: np.uint64, b: np.uint64) -> np.uint64:
    """The product modulo 2**64."""
    return np.uint64(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Mixed polynomial hashes of all ``k``-grams."""
    done, out, step, power, block = 0, None, 1, BASE, codes
    while True:
        if k & step:
            if out is None:
                out, done, out_power = block, step, power
            else:
                # the block of `step` codes first, what is done behind it
                n = len(codes) - done - step + 1
                out = block[:n] * out_power + out[step:step + n]
                done, out_power = done + step, times(out_power, power)
        if done == k:
            break
        n = len(block) - step
        block = block[:n] * power + block[step:step + n]
        power, step = times(power, power), step * 2
    out = out ^ (out >> np.uint64(31))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    out = out ^ (out >> np.uint64(27))
    return out * np.uint64(0x94D049BB133111EB)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    length = 1
    while length < width:
        step = min(length, width - length)
        keys = np.minimum(keys[:-step], keys[step:])
        length += step
    return keys


def winnow(text: str, k: int = K, window: int = WINDOW, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(values, positions) that the windows of ``text`` choose, by position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(codes) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, len(codes))
    last = np.uint64((1 << POSITION_BITS) - 1)
    values, positions = [], []
    for start in range(0, len(codes) - k + 1, block):
        # a block takes along the grams of the windows that begin in it
        hashes = gram_hashes(codes[start:start + block + window + k - 2], k)
        if start and len(hashes) < window:
            break
        keys = (hashes >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | (
            last - np.arange(len(hashes), dtype=np.uint64))
        chosen = np.unique(sliding_min(keys, min(window, len(keys))))
        at = (last - (chosen & last)).astype(np.int64)
        order = np.argsort(at)
        values.append(chosen[order] >> np.uint64(POSITION_BITS))
        positions.append(at[order] + start)
    values, positions = np.concatenate(values), np.concatenate(positions)
    positions, first = np.unique(positions, return_index=True)
    return values[first], positions


def as_string(print_: tuple[np.ndarray, np.ndarray]) -> str:
    return ",".join([f"{v:x}:{p:x}" for v, p in zip(print_[0].tolist(), print_[1].tolist(), strict=True)])


def likeness(one: set, other: set) -> float:
    """Common values among all values."""
    return len(one & other) / len(one | other) if one or other else 1.0


def neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, window: int = WINDOW) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last quarter replaced by the opening of the next
    document), and the likeness of its fingerprint to that and to the next document's."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.select(F.col(key).cast("double").alias("id")).approxQuantile(
        "id", [n / ranges for n in range(1, ranges)], 0.1 / ranges if ranges > 1 else 0.1) or [0.0]))
    dealt = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="x", outputCol="range",
                       handleInvalid="keep")

    def ranged(frame):
        # ids that are NULL go to a range behind all others
        return dealt.transform(frame.withColumn("x", F.coalesce(F.col("id").cast("double"), F.lit(float("nan"))))).drop("x")

    # one row per range, of a number that is set above
    heads = sorted(ranged(docs.select(F.col(key).cast("long").alias("id"))).groupBy("range")
                   .agg(F.min("id").alias("head")).collect(), key=lambda r: r["range"])
    before = [(r["range"], r["head"], heads[n - 1]["range"]) for n, r in enumerate(heads)]
    small = spark.createDataFrame(before, "range double, head long, before double")
    placed = ranged(rows).join(F.broadcast(small), "range").select(
        "id", "text", F.explode(F.expr(
            "IF(id <=> head, array(struct(range AS range, 0 AS ahead), struct(before AS range, 1 AS ahead)), "
            "array(struct(range AS range, 0 AS ahead)))")).alias("to")).select("to.range", "to.ahead", "id", "text")

    def walk(batches):
        held, inside, out = None, None, []
        for batch in batches:
            for at, ahead, doc_id, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != inside:
                    held, inside, closed = None, at, False
                if closed:
                    continue
                print_ = winnow(body, k, window)
                values = set(print_[0].tolist())
                if held is not None:
                    out.append(compare(held, body, values))
                held, closed = (doc_id, body, print_, values), ahead == 1
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=layout)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=layout)

    def compare(held, following, next_values):
        doc_id, body, print_, values = held
        cut = len(body) // 4
        edited = body[:len(body) - cut] + following[:cut]
        changed = winnow(edited, k, window)
        return {"doc_id": doc_id, "n_chars": len(body), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                "fingerprint": as_string(print_), "edited_fingerprint": as_string(changed),
                "near_edited": likeness(values, set(changed[0].tolist())), "near_next": likeness(values, next_values)}

    layout = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    ordered = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "range").sortWithinPartitions(
        "range", "ahead", F.col("id").asc_nulls_last(), "text")
    return ordered.mapInArrow(walk, RESULT)
