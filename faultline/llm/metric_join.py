"""Embedding near-dedup: an exact metric range join in cells around pivots.

Vectors of length one with cosine c lie at the angle acos(c), which is a metric; links are the pairs within the angle r of
the least cosine. Equal vectors are joined first: one stands for all of them. Pivots are a bounded sample of vectors; each
vector is at home in the cell of its nearest pivot. Homes are cut into blocks of bounded size by a hash. A vector x of
another block visits a block of cell j as a guest only if the triangle inequality leaves room for a partner there:

* angle(x, p_j) - r must not be over the cell's radius (its farthest vector from p_j), and
* the distance of x to the border between its own cell i and cell j, whose sine is (x.p_i - x.p_j) / |p_i - p_j|, must
  not be over r.

Of two blocks only one gets guests, the later one if their numbers add up to an even one, else the earlier, so every pair is
looked at once and no block takes them all. Blocks join independently: a block's
home vectors lie in memory as one matrix, guests stream past in batches. Single precision proposes pairs down to a margin
that covers its rounding, double precision decides. Nothing is approximate; pivots only decide how much is looked at.

A block gives out links per vector and the edges of a spanning forest (guest to its first partner's root, home to its
root), never all pairs of a group, so what is shuffled grows with the vectors, not with the links.

In many dimensions random vectors stand at right angles and cells overlap almost everywhere: there the bound prunes
little, and the join is a blocked comparison of all vectors (as any exact join on such data).

Cases: NULL vectors, zero vectors, those with NULL, infinite or undefined components, and those of another length than
their partner link with nothing and are their own component; rows with equal ids are compared each, and share the sum of
their links and one component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.components import components
from faultline.session import materialize

LEAST_COSINE = 0.9
BLOCK_ROWS = 4096
MOST_PIVOTS = 1024
MARGIN = 1e-4


def directions(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision. The largest entry is taken out first: squares of very small and of very
    large numbers do not fit a double."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def distinct_vectors(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(one row per distinct usable vector: ``rep``, ``copies``, ``vec``; every row's ``id`` and ``rep``)."""
    value = F.col("vec")
    usable = (F.size(value) > 0) & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(value, lambda x: x != 0)
    written = F.array_join(F.transform(value, lambda x: (x + F.lit(0.0)).cast("string")), ",")
    keyed = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).withColumn(
        "same", F.when(F.coalesce(usable, F.lit(False)), F.sha2(written, 256)))
    keyed = materialize(keyed, "vectors")
    groups = keyed.filter("same IS NOT NULL").groupBy("same").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    groups = materialize(groups, "distinct_vectors")
    member = keyed.select("id", "same").join(groups.select("same", "rep", "copies"), "same", "left").select(
        "id", "rep", "copies")
    return groups, member


def linked(distinct: DataFrame, least: float = LEAST_COSINE, block_rows: int = BLOCK_ROWS,
           most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """Rows ``id, n, root``: links counted at one place (weighted by copies) and an edge of the forest (or NULL)."""
    spark = distinct.sparkSession
    total = distinct.count()
    schema = "id bigint, n bigint, root bigint"
    if not total:
        return spark.createDataFrame([], schema)
    wanted = min(most_pivots, max(1, -(-total // block_rows)))
    # a bounded sample: as many rows as pivots
    sample = distinct.orderBy(F.xxhash64("same")).limit(wanted).select("vec").collect()
    width = max(len(r["vec"]) for r in sample)
    pivots = directions(np.array([r["vec"] for r in sample if len(r["vec"]) == width]))
    reach = float(np.arccos(least)) + 1e-9

    def house(batches):
        for batch in batches:
            for dims in np.unique(np.array([len(v) for v in batch.column("vec")])):
                rows = batch.filter(pa.array(np.array([len(v) for v in batch.column("vec")]) == dims))
                x = directions(matrix(rows.column("vec")))
                if dims == width:
                    near = x @ pivots.T
                    home = near.argmax(axis=1)
                    angle = np.arccos(np.clip(near.max(axis=1), -1, 1))
                else:
                    home, angle = np.full(len(x), -int(dims)), np.zeros(len(x))
                yield pa.record_batch([rows.column("rep"), rows.column("copies"), rows.column("vec"),
                                       pa.array(home, pa.int32()), pa.array(angle)],
                                      names=["id", "copies", "vec", "cell", "angle"])

    homes = materialize(distinct.select("rep", "copies", "vec").mapInArrow(
        house, "id bigint, copies bigint, vec array<double>, cell int, angle double"), "cells")
    # one row per cell: pivots and vector lengths bound their number
    cells = {r["cell"]: (r["rows"], r["radius"]) for r in homes.groupBy("cell").agg(
        F.count("*").alias("rows"), F.max("angle").alias("radius")).collect()}
    first, blocks = {}, []
    for cell in sorted(cells):
        first[cell] = len(blocks)
        blocks += [cell] * -(-cells[cell][0] // block_rows)
    shares = {cell: -(-cells[cell][0] // block_rows) for cell in cells}

    def takes(own: np.ndarray, block: int) -> np.ndarray:
        """Whether ``block`` gets the guests of the pair it forms with ``own``."""
        return (own != block) & ((own < block) == ((own + block) % 2 == 0))

    def visit(batches):
        target = np.array(blocks)
        radius = np.array([cells[c][1] for c in blocks])
        placed = np.flatnonzero(target >= 0)
        for batch in batches:
            ids, cell = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            own = np.array([first[c] + (i * 0x9E3779B1 >> 7) % shares[c]
                            for i, c in zip(ids.tolist(), cell.tolist(), strict=True)])
            row, to = [np.arange(len(ids))], [own]
            for dims in np.unique(cell[cell < 0]):
                at = np.flatnonzero(cell == dims)
                for block in range(first[dims], first[dims] + shares[dims]):
                    guests = at[takes(own[at], block)]
                    row.append(guests)
                    to.append(np.full(len(guests), block))
            at = np.flatnonzero(cell >= 0)
            if len(at):
                x = directions(matrix(batch.column("vec").take(pa.array(at))))
                near = x @ pivots.T
                mine = near[np.arange(len(at)), cell[at]]
                for block in placed:
                    j = target[block]
                    gap = np.linalg.norm(pivots - pivots[j], axis=1)[cell[at]]
                    border = np.where(gap > 0, (mine - near[:, j]) / np.where(gap > 0, gap, 1), 0.0)
                    may = takes(own[at], block) & (np.arccos(np.clip(near[:, j], -1, 1)) - reach <= radius[block]) & (
                        border <= np.sin(min(reach, np.pi / 2)) + 1e-9)
                    row.append(at[may])
                    to.append(np.full(int(may.sum()), block))
            row, to = np.concatenate(row), np.concatenate(to)
            take = pa.array(row)
            yield pa.record_batch([pa.array(to, pa.int32()), pa.array(own[row] != to), batch.column("id").take(take),
                                   batch.column("copies").take(take), batch.column("vec").take(take)],
                                  names=["block", "guest", "id", "copies", "vec"])

    dealt = homes.mapInArrow(visit, "block int, guest boolean, id bigint, copies bigint, vec array<double>")
    parts = min(len(blocks), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    ordered = dealt.repartition(parts, "block").sortWithinPartitions("block", "guest", "id")

    def join(batches):
        block = None
        for batch in batches:
            numbers = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if block is None or block.number != numbers[a]:
                    if block is not None:
                        yield from block.close()
                    block = Block(numbers[a], least)
                yield from block.add(batch.slice(a, b - a))
        if block is not None:
            yield from block.close()

    return ordered.mapInArrow(join, schema)


class Block:
    """Home vectors of one block; guests stream past."""

    def __init__(self, number: int, least: float):
        self.number, self.least, self.parts, self.ready = number, least, [], False

    def add(self, batch: pa.RecordBatch):
        guest = batch.column("guest").to_numpy(zero_copy_only=False)
        homes = batch.filter(pa.array(~guest))
        if len(homes):
            self.parts.append((homes.column("id").to_numpy(), homes.column("copies").to_numpy(),
                               directions(matrix(homes.column("vec")))))
        if guest.any():
            self.open()
            guests = batch.filter(pa.array(guest))
            yield from self.compare(guests.column("id").to_numpy(), guests.column("copies").to_numpy(),
                                    directions(matrix(guests.column("vec"))))

    def open(self) -> None:
        if self.ready:
            return
        self.ids, self.copies, self.x = (np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 1)))
        self.single = self.x.astype(np.float32)
        self.links, self.root = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
        self.ready = True
        for at in range(0, len(self.ids), 512):
            i, j = self.near(self.x[at:at + 512])
            keep = i + at < j
            i, j = i[keep] + at, j[keep]
            np.add.at(self.links, i, self.copies[j])
            np.add.at(self.links, j, self.copies[i])
            self.union(i, j)

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``x``, home) of all links, decided in double precision."""
        if not len(self.ids) or not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i, j = np.nonzero(x.astype(np.float32) @ self.single.T >= self.least - MARGIN)
        ok = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 18):
            part = slice(at, at + (1 << 18))
            ok[part] = np.einsum("ij,ij->i", x[i[part]], self.x[j[part]]) >= self.least
        return i[ok], j[ok]

    def union(self, i: np.ndarray, j: np.ndarray) -> None:
        """Homes ``i`` and ``j`` get the smaller root until none changes."""
        while len(i):
            low = np.minimum(self.root[i], self.root[j])
            np.minimum.at(self.root, self.root[i], low)
            np.minimum.at(self.root, self.root[j], low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
            open_ = self.root[i] != self.root[j]
            i, j = i[open_], j[open_]

    def compare(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray):
        for at in range(0, len(ids), 512):
            i, j = self.near(x[at:at + 512])
            if not len(i):
                continue
            np.add.at(self.links, j, copies[at:at + 512][i])
            who, opens = np.unique(i, return_index=True)
            self.union(np.repeat(j[opens], np.diff(np.append(opens, len(i)))), j)
            counts = np.add.reduceat(self.copies[j], opens)
            yield rows_of(ids[at + who], counts, self.ids[j[opens]])

    def close(self):
        self.open()
        if len(self.ids):
            yield rows_of(self.ids, self.links, self.ids[self.root])


def rows_of(ids: np.ndarray, counts: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids), pa.array(counts), pa.array(roots)], names=["id", "n", "root"])


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE,
                 block_rows: int = BLOCK_ROWS, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """Per row ``key, n_links, component_id, kept``."""
    distinct, member = distinct_vectors(rows, key, vector)
    found = materialize(linked(distinct, least, block_rows, most_pivots), "links")
    sums = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.filter("id <> root"), "id", "root")
    labelled = member.join(sums.withColumnRenamed("id", "rep"), "rep", "left").join(
        groups.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("component_id", "rep", "id")
    links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("n", F.lit(0))
    return labelled.select(F.col("id").alias(key), links.cast("long").alias("n_links"), component.alias("component_id"),
                           (F.col("id") == component).alias("kept"))
