"""Toxicity: a linear classifier whose score must not move when identity terms are swapped.

Features of a text are which words it holds (lower case, letters only) and which openings of four to six letters its words
have, so that inflected forms of a term count together. ``learn`` fits on at most ``SAMPLE`` labelled rows, taken by a hash
of the id: counts per feature and label choose the features that tell the labels apart, then a logistic model is fitted
to

    log loss + l2/2 |w|^2 + penalty * mean (z(x) - z(x'))^2

where z is the score before the logistic function and x' is the sentence with every identity term replaced by another
term of its group. Identity terms are features in any case, so the penalty can hold their weights down although a few of
them happen to stand in toxic rows; a neutral mention of a group then changes nothing. The fitted model is a few thousand
numbers; scoring runs where the texts are, without a shuffle.

Labels are used only in ``learn``, and only of rows that are not held out (``held_out``: CRC-32 of the id's decimal digits
modulo 5 is 0). Language, source and id are never features.

Cases: a NULL or empty text has the score of a text without features; a NULL id is not held out and never learnt from; a
row with several labels counts as toxic if one says so, NULL labels are dropped; without usable labels, or with one class
only, every score is the share of toxic rows (0 without rows); repeated rows are scored each; an empty table gives an
empty result; other columns are not read by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes, gather, parts_of, small_batches
from faultline.session import materialize

SAMPLE = 12_000
SLICE_BYTES = 1 << 20
FEATURES = 4096
LEAST_G = 15.0
OPENINGS = (4, 5, 6)

#: Identity terms in groups; a term is swapped for the next one of its group (fixed values).
IDENTITY = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("immigrants", "refugees", "foreigners", "natives", "ausländer", "flüchtlinge", "étrangers", "inmigrantes"),
    ("blind", "deaf", "disabled", "autistic", "paralysed"),
    ("old", "young", "elderly", "teenage"),
    ("german", "french", "spanish", "english", "american", "mexican", "chinese", "russian", "turkish", "indian"),
)
SWAP = {term: group[(n + 1) % len(group)] for group in IDENTITY for n, term in enumerate(group)}
find_words = re.compile(r"[^\W\d_]+").findall


def features_of(word: str) -> list[str]:
    """A word and its openings."""
    return [word, *(f"{word[:n]}*" for n in OPENINGS if len(word) >= n)]


def part_features(parts: list[str], swap: bool = False) -> list[list[str]]:
    """Features of each part of a text; parts hold whole words."""
    out = []
    for part in parts:
        words = find_words(part.lower())
        if swap:
            words = [SWAP.get(w, w) for w in words]
        out.append([f for w in words for f in features_of(w)])
    return out


def present(texts: pa.Array, known: dict[str, int], swap: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs of ``texts``, each once, sorted; features are numbered by ``known``. Each distinct word is
    looked up once and everything after that is integers, so memory follows the bytes of ``texts``."""
    parts, index, first = parts_of(texts.cast(pa.string()), False)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    held = np.unique(row * max(1, len(parts)) + index)  # a part counts once per text
    row, index = np.divmod(held, max(1, len(parts)))
    flat, offsets, of_word = array("i"), np.zeros(len(parts) + 1, np.int64), {}
    for n, part in enumerate(parts.to_pylist()):
        for word in find_words(part.lower()):
            ids = of_word.get(word)
            if ids is None:
                taken = SWAP.get(word, word) if swap else word
                ids = of_word[word] = tuple([known[f] for f in features_of(taken) if f in known])
            flat.extend(ids)
        offsets[n + 1] = len(flat)
    feature, _ = gather(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32), offsets, index)
    coded = np.unique(np.repeat(row, np.diff(offsets)[index]) * max(1, len(known)) + feature)
    return np.divmod(coded, max(1, len(known)))


@dataclass
class Model:
    """Names of features, their weights, and the score of a text without any."""

    names: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        if self.names and len(texts):
            row, feature = present(texts, {name: n for n, name in enumerate(self.names)})
            z += np.bincount(row, self.weights[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit(label: np.ndarray, x: tuple, swapped: tuple, width: int, l2: float, penalty: float, steps: int = 400):
    """(weights, bias) by Adam on the full gradient. ``x`` and ``swapped``: (row, feature) pairs."""
    n = len(label)
    share = (label.sum() + 0.5) / (n + 1)
    w, b = np.zeros(width), float(np.log(share / (1 - share)))
    moved = np.unique(np.setdiff1d(np.concatenate([x[0] * width + x[1], swapped[0] * width + swapped[1]]),
                                   np.intersect1d(x[0] * width + x[1], swapped[0] * width + swapped[1])) // width)
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(x[0], w[x[1]], n)
        off = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - label
        grad = np.bincount(x[1], off[x[0]], width) / n + l2 * w
        if len(moved):
            gap = np.zeros(n)
            gap[moved] = (z - b - np.bincount(swapped[0], w[swapped[1]], n))[moved] * (2 * penalty / len(moved))
            grad += np.bincount(x[1], gap[x[0]], width) - np.bincount(swapped[1], gap[swapped[0]], width)
        grad = np.append(grad, off.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text, toxic`` of at most ``sample`` rows that are not held out; few enough ids to be broadcast."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    held = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic"))
    # a share of the ids by hash, half as many again as asked for, so that sorting does not send more to the driver
    share = 1_000_000 * min(1.0, 1.5 * sample / max(1, usable.count()))
    chosen = held.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < F.lit(share)).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text")).join(F.broadcast(chosen), "doc_id").select(
        "doc_id", F.col("__text").alias("text"), F.col("__toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, l2: float = 1e-4, penalty: float = 1.0) -> Model:
    """A model from the labelled rows of ``docs`` that are not held out, at most ``sample`` of them."""
    rows = materialize(labelled_sample(docs, labels, sample), "labelled")

    def count(batches):
        from collections import Counter
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist())
            totals = Counter({("", 0): int((toxic == 0).sum()), ("", 1): int((toxic == 1).sum())})
            for text, label in zip(batch.column(0).to_pylist(), toxic.tolist(), strict=True):
                totals.update((f, label) for f in {f for fs in part_features(text.split(" ")) for f in fs})
            keys = list(totals)
            yield pa.record_batch([pa.array([f for f, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()),
                                   pa.array([totals[k] for k in keys], pa.int64())], names=["feature", "toxic", "n"])

    counted = rows.select("text", "toxic").mapInArrow(count, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q")).filter(F.col("p") + F.col("q") >= 5)
    counted = materialize(counted, "counted")
    totals = counted.filter(F.col("feature") == "").first()
    positive, negative = (totals["p"], totals["q"]) if totals else (0, 0)
    if not positive or not negative:
        share = positive / max(1, positive + negative)
        return Model(bias=float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = positive / (positive + negative)
    both = F.col("p") + F.col("q")
    total = positive + negative
    told = 2 * (term(F.col("p"), both * share) + term(F.col("q"), both * (1 - share))
                + term(positive - F.col("p"), (total - both) * share) + term(negative - F.col("q"), (total - both) * (1 - share)))
    chosen = counted.filter(F.col("feature") != "").withColumn("g", told).filter(F.col("g") >= LEAST_G).orderBy(
        F.desc("g"), "feature").limit(FEATURES).collect()
    names = sorted({r["feature"] for r in chosen} | set(SWAP))
    known = {name: n for n, name in enumerate(names)}

    def design(batches):
        for batch in batches:
            texts = batch.column(0)
            here, there = present(texts, known), present(texts, known, swap=True)
            bounds = np.arange(len(texts) + 1)
            lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(r, bounds), pa.int32()), pa.array(f, pa.int32()))
                     for r, f in (here, there)]
            yield pa.record_batch([batch.column(1), *lists], names=["toxic", "here", "there"])

    got = rows.orderBy("doc_id", "text").select("text", "toxic").mapInArrow(
        design, "toxic int, here array<int>, there array<int>").toPandas()

    def pairs(column) -> tuple[np.ndarray, np.ndarray]:
        sizes = column.map(len).to_numpy()
        return np.repeat(np.arange(len(got)), sizes), np.concatenate([*column, np.zeros(0)]).astype(np.int64)

    weights, bias = fit(got["toxic"].to_numpy(np.float64), pairs(got["here"]), pairs(got["there"]), len(names), l2, penalty)
    used = np.flatnonzero(weights)
    return Model([names[n] for n in used], weights[used], bias)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def run(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                yield pa.record_batch([rows.column(0), pa.array(model.scores(rows.column(1)))], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under 0.5, all columns kept. Rows are judged where they lie, one by one, so
    repeated ids cannot meet; whole rows stay in Arrow and are filtered by a mask, a few megabytes of text at a time."""
    at = docs.columns.index(text)

    def judge(batches):
        for batch in batches:
            for rows in by_bytes(batch, text, SLICE_BYTES):
                clean = model.scores(pc.fill_null(rows.column(at), "")) < 0.5
                yield rows.filter(pa.array(clean))

    return small_batches(docs).mapInArrow(judge, docs.schema)
