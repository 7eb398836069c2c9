"""Quality rules: statistics of every text, and an isolation forest that tells which texts stand apart.

``statistics`` reads whole texts once, in Arrow slices of bounded size. Words are runs of characters other than space and
the control characters 9 to 13. ``base_failed`` is a plain rule on these numbers: fewer than 50 words, or more than half of the
words in 3-word windows that stand in the text twice or more.

The forest sees how far a text is past the usual bound of each rule (``BOUNDS``), as shares, not sizes, so that a long text is
judged as a short one. ``grow`` takes rows that pass the plain rule and builds ``TREES`` trees, each by one task from its
own ``TREE_ROWS`` rows, chosen by a hash: a node splits a random measure at a random place between its least and largest
value, until a row is alone or the tree is log2(``TREE_ROWS``) deep. A row's depth over all trees, as a share of the depth
expected at random, gives the score 2^(-share): rows that few splits set apart score high. The forest is a few thousand
numbers, whatever the table's size; scoring runs where the rows are.

``calibrate`` counts the labelled rows per score (in 1024 steps, on the cluster) and takes the cut with the best sum of the
shares of good rows kept and of bad rows rejected; of equal cuts the middle one.

The sample of the forest is bounded by ``TREES`` x ``TREE_ROWS`` rows; statistics, scores and the cut cover all rows.

Cases: a NULL or empty text has no words and fails the plain rule; a NULL id is kept and never labelled; rows with equal
ids or texts are judged each; a row with several labels is good only if all say so; NULL labels are dropped; without
labelled rows of both kinds, or without rows for the forest, the plain rule alone decides; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes
from faultline.session import materialize

SLICE_BYTES = 4 << 20
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
TREES, TREE_ROWS, STEPS = 200, 64, 1024
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
          "n_digits", "n_marks"]
#: The usual bounds of the rules: characters a word, and shares of symbols and so on.
BOUNDS = {"least chars a word": 3, "most chars a word": 8, "symbols": 0.0, "equal lines": 0.2, "repeated words": 0.2,
          "distinct words": 0.4, "capitals": 0.1, "digits": 0.15, "marks": 0.08}



def repeats(row: np.ndarray, word: np.ndarray, texts: int) -> np.ndarray:
    """Per text its words that lie in a window of 3 which the text holds twice or more. Words are numbers; no hashes."""
    n = len(word) - WINDOW + 1
    if n < 1:
        return np.zeros(texts, np.int64)
    inside = row[:n] == row[WINDOW - 1:]
    code = word[:n]
    for k in range(1, WINDOW):
        _, code = np.unique(code * (int(word.max()) + 1) + word[k:k + n], return_inverse=True)
    _, which, times = np.unique(np.where(inside, row[:n] * (int(code.max()) + 1) + code, -1), return_inverse=True,
                                return_counts=True)
    again = inside & (times[which] > 1)
    held = np.zeros(len(word), bool)
    for k in range(WINDOW):
        held[k:k + n] |= again
    return np.bincount(row[held], minlength=texts)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of non-null texts."""
    texts = texts.cast(pa.string())
    total = len(texts)

    def found(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64)

    def pieces(values: pa.Array, at: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(text, number) of every piece, and the distinct pieces."""
        split = pc.split_pattern(values, at)
        offsets = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return np.repeat(np.arange(total), np.diff(offsets)), number, coded.dictionary

    def distinct(row: np.ndarray, number: np.ndarray) -> np.ndarray:
        width = int(number.max(initial=0)) + 1
        return np.bincount(np.unique(row * width + number) // width, minlength=total) if len(row) else np.zeros(total, np.int64)

    row, line, lines = pieces(texts, "\n")
    filled = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[line]
    row, line = row[filled], line[filled]
    out = {"n_lines": np.bincount(row, minlength=total)}
    out["n_dup_lines"] = out["n_lines"] - distinct(row, line)
    row, word, words = pieces(pc.replace_substring_regex(texts, r"[\x09-\x0D]", " "), " ")
    filled = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[word]
    row, word = row[filled], word[filled]
    out["n_words"] = np.bincount(row, minlength=total)
    out["n_distinct"] = distinct(row, word)
    out["n_repeat_words"] = repeats(row, word, total)
    out["word_chars"] = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) - found(r"[\x20\x09-\x0D]")
    out["n_symbols"], out["n_upper"] = found(r"[#*$%&|<>]"), found(r"\p{Lu}")
    out["n_digits"], out["n_marks"] = found(r"[0-9]"), found(r"[!?.,;:]")
    return {name: out[name] for name in COUNTS}


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every row."""

    def count(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                counts = text_counts(rows.column(1))
                yield pa.record_batch([rows.column(0), *[pa.array(c, pa.int64()) for c in counts.values()]],
                                      names=["doc_id", *COUNTS])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(count, ", ".join(f"{name} bigint" for name in ["doc_id", *COUNTS]))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def measures() -> Column:
    """How far a text is past each bound, as an array of doubles, from the columns of ``statistics``."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    length, lines = F.col("word_chars") / words, F.greatest("n_lines", F.lit(1))

    def over(share: Column, name: str) -> Column:
        return F.greatest(share - F.lit(BOUNDS[name]), F.lit(0.0))

    return F.array(
        F.greatest(F.lit(BOUNDS["least chars a word"]) - length, length - BOUNDS["most chars a word"], F.lit(0.0)),
        over(F.col("n_symbols") / chars, "symbols"), over(F.col("n_dup_lines") / lines, "equal lines"),
        over(F.col("n_repeat_words") / words, "repeated words"),
        F.greatest(F.lit(BOUNDS["distinct words"]) - F.col("n_distinct") / words, F.lit(0.0)),
        over(F.col("n_upper") / chars, "capitals"), over(F.col("n_digits") / chars, "digits"),
        over(F.col("n_marks") / chars, "marks")).cast("array<double>")


def expected_depth(rows: int) -> float:
    """The mean depth of a search that fails in a random binary tree of so many rows."""
    return 0.0 if rows < 2 else 2 * float(np.sum(1 / np.arange(1, rows))) - 2 * (rows - 1) / rows


@dataclass
class Forest:
    """Nodes of all trees: measure (-1: a leaf), cut, the two next nodes, and a leaf's depth."""

    roots: np.ndarray
    measure: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    depth: np.ndarray
    usual: float
    levels: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            for _ in range(self.levels):
                measure = self.measure[at]
                goes_low = x[every, measure] < self.cut[at]
                at = np.where(measure < 0, at, np.where(goes_low, self.low[at], self.high[at]))
            total += self.depth[at]
        return 2.0 ** (-total / self.usual) if self.usual else np.zeros(len(x))


def tree_nodes(x: np.ndarray, rng: np.random.Generator, levels: int) -> list[tuple]:
    """(node, measure, cut, low, high, depth) of one tree over the rows of ``x``; node 0 is the root."""
    nodes: list[tuple] = []
    waiting = [(np.arange(len(x)), 0, -1, 0)]
    while waiting:
        rows, depth, parent, side = waiting.pop()
        node = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = node
        low, high = (x[rows].min(axis=0), x[rows].max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        apart = np.flatnonzero(high > low)
        if depth == levels or not len(apart):
            nodes.append([node, -1, 0.0, node, node, depth + expected_depth(len(rows))])
            continue
        measure = int(rng.choice(apart))
        cut = float(high[measure] - (high[measure] - low[measure]) * rng.random())  # over the least: no side is empty
        nodes.append([node, measure, cut, node, node, 0.0])
        below = x[rows, measure] < cut
        waiting += [(rows[below], depth + 1, node, 0), (rows[~below], depth + 1, node, 1)]
    return nodes


def grow(rows: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 11) -> Forest:
    """A forest from a bounded sample of ``rows`` (columns of ``statistics``)."""
    levels = max(1, int(np.ceil(np.log2(tree_rows))))
    chance = F.pmod(F.xxhash64(*COUNTS, "doc_id", F.lit(seed)), F.lit(1 << 40))
    share = min(1.0, 2.0 * trees * tree_rows / max(1, rows.count()))
    picked = rows.withColumn("chance", chance).filter(F.col("chance") <= F.lit(int(share * (1 << 40)))).orderBy(
        "chance", "doc_id").limit(trees * tree_rows).select("chance", measures().alias("x"))
    picked = materialize(picked, "forest_rows")
    each = min(1.0, 2.0 * tree_rows / max(1, picked.count()))
    dealt = picked.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "turn", F.pmod(F.xxhash64("chance", "tree"), F.lit(1 << 40))).filter(F.col("turn") <= F.lit(int(each * (1 << 40))))

    def plant(group: pa.Table) -> pa.Table:
        group = group.sort_by([("turn", "ascending"), ("chance", "ascending")]).slice(0, tree_rows)
        tree = group.column("tree")[0].as_py()
        x = group.column("x").combine_chunks().flatten().to_numpy().reshape(len(group), -1)
        nodes = [[tree, len(x), *node] for node in tree_nodes(x, np.random.default_rng((seed, tree)), levels)]
        return pa.table({name: pa.array(list(c)) for name, c in zip(NODE, zip(*nodes, strict=True), strict=True)}).cast(ARROW)

    found = dealt.groupBy("tree").applyInArrow(plant, ", ".join(f"{n} {t}" for n, t in NODE.items())).toArrow()
    found = found.sort_by([("tree", "ascending"), ("node", "ascending")])
    part = {name: found.column(name).to_numpy() for name in NODE}
    roots = np.flatnonzero(part["node"] == 0)
    base = np.repeat(roots, np.diff(np.append(roots, len(found))))
    usual = sum(expected_depth(int(n)) for n in part["rows"][roots])
    return Forest(roots, part["measure"], part["cut"], part["low"] + base, part["high"] + base, part["depth"], usual, levels)


NODE = {"tree": "int", "rows": "int", "node": "int", "measure": "int", "cut": "double", "low": "int", "high": "int",
        "depth": "double"}
ARROW = pa.schema([(n, pa.float64() if t == "double" else pa.int32()) for n, t in NODE.items()])


def scored(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` (columns of ``statistics``) with ``score``."""

    def judge(batches):
        for batch in batches:
            x = batch.column(len(COUNTS) + 1).flatten().to_numpy().reshape(len(batch), -1)
            yield pa.record_batch([*batch.columns[:-1], pa.array(forest.scores(x))], names=["doc_id", *COUNTS, "score"])

    return rows.select("doc_id", *COUNTS, measures().alias("x")).mapInArrow(
        judge, ", ".join(f"{name} bigint" for name in ["doc_id", *COUNTS]) + ", score double")


def calibrate(rows: DataFrame, labels: DataFrame) -> float:
    """The cut for ``score`` of ``rows``; from there on rows are rejected."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).alias("step")
    counted = rows.filter(~base_failed()).join(known, "doc_id").groupBy(step, (F.col("quality") > 0).alias("good")).count()
    good, bad = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    for r in counted.collect():
        (good if r["good"] else bad)[r["step"]] = r["count"]
    if not good.sum() or not bad.sum():
        return float("inf")
    # at cut s / STEPS the steps below s are kept
    worth = (np.cumsum(good) - good) / good.sum() + (bad.sum() - np.cumsum(bad) + bad) / bad.sum()
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    run = best[best >= best[-1] - np.arange(len(best))[::-1]]  # the last run of neighbouring best cuts
    return float(run[len(run) // 2]) / STEPS


def quality_report(docs: DataFrame, labels: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``doc_id``, ``COUNTS``, ``score``, ``base_failed`` and ``kept`` of every row of ``docs``."""
    rows = materialize(statistics(docs), "statistics")
    forest = grow(rows.filter(~base_failed()), trees, tree_rows)
    if not len(forest.roots):
        judged, cut = rows.withColumn("score", F.lit(0.0)), float("inf")
    else:
        judged = materialize(scored(rows, forest), "scored")
        cut = calibrate(judged, labels)
    return judged.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") < F.lit(cut)))
