"""MinHash near-dedup by a signature-coordinate inverted join.

A document is the set of its word shingles. Documents with equal sets are joined first, by a digest of the set. A
signature has ``COORDINATES`` tokens, one per coordinate: the smallest value of that coordinate's hash over the set. Two
sets of similarity s agree in a share s of the coordinates on average; pairs that agree in fewer than ``MATCHES`` are not
looked at (at s = 0.8 that misses a pair with a chance of some millionths), all others are confirmed on their full sets.

Inverted join. Documents are posted under their tokens. With all tokens in one order, rare ones first, two signatures with
``MATCHES`` tokens in common share one among the first ``COORDINATES - MATCHES + 1`` of both: only this prefix is posted
(prefix merging), and a token that only one document has posts nothing (skip merging).

Blocks. Each posting belongs to the block of its smallest document, so that a document meets the many postings it shares
with others of a group in one or a few blocks, where it arrives once. First collisions are counted in the blocks on
signatures cut to one byte a coordinate (which can only add collisions): documents without a partner above the threshold
leave. The others come again with their full sets: pairs above the threshold are confirmed, and linked documents become
one local group; pairs within a group cannot change it and are passed over. A few documents are compared with all others
first; then only those outside the largest group are. What leaves a block is a spanning forest of confirmed links, never the pairs of a group.
Blocks beyond ``TILE`` shingles are cut into tiles by a hash of the documents, and every pair of tiles is a task of its
own: nothing is capped, and a popular posting, or a group of copies with a large share of all rows, is many tasks.

Cases: a NULL text, and one without words, has an empty set and links with nothing; a text with fewer words than a
shingle has one shingle; copies share a set, however many; rows with equal ids share a component and each has its own
links: where an id has different sets, rows are numbered and joined by their numbers, and the components of an id's rows
are joined afterwards; a NULL id links with nothing, has no component and is kept; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes, gather, small_batches
from faultline.llm.components import components
from faultline.llm.shingles import shingle_sets
from faultline.session import materialize

COORDINATES, MATCHES = 64, 36
#: Shingles of a tile, about; and documents that are compared with all others of a block before its groups are looked at.
TILE, CENTRES = 1 << 20, 8
#: Ids of up to so many documents (32 MB) are broadcast when their texts are looked up; beyond, both sides are shuffled.
BROADCAST_IDS = 4_000_000
SLICE_BYTES = 1 << 20
PERCENT = 80


def multipliers(coordinates: int) -> np.ndarray:
    """An odd factor for every coordinate."""
    return np.random.default_rng(20240601).integers(0, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(values: np.ndarray, offsets: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """One row of tokens for every non-empty set, in order."""
    opens = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(opens), coordinates), np.uint64)
    if not len(opens):
        return out
    for n, factor in enumerate(multipliers(coordinates)):
        hashed = values * factor
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xD6E8FEB86659FD93)
        out[:, n] = np.minimum.reduceat(hashed, opens)
    # a token names its coordinate: equal values of different coordinates must not meet
    return out ^ (np.arange(coordinates, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def signed(docs: DataFrame, size: int, text: str, key: str) -> DataFrame:
    """``id, n, same`` (digest of the set, NULL if it is empty), ``tokens`` and ``marks`` (their last bytes) of every row."""

    def sign(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                values, offsets = shingle_sets(rows.column(1), size)
                sizes = np.diff(offsets)
                tokens = signatures(values, offsets).view(np.int64)
                view = memoryview(values)
                same = [xxhash.xxh3_128_hexdigest(view[a:b]) if b > a else None
                        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                bounds = np.concatenate([[0], np.cumsum(sizes > 0)]) * COORDINATES
                short = iter((tokens & 0xFF).astype(np.uint8))
                marks = [next(short).tobytes() if n else None for n in sizes.tolist()]
                yield pa.record_batch([
                    rows.column(0), pa.array(sizes, pa.int64()), pa.array(same, pa.string()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tokens.reshape(-1))),
                    pa.array(marks, pa.binary())], names=["id", "n", "same", "tokens", "marks"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return small_batches(rows).mapInArrow(sign, "id bigint, n bigint, same string, tokens array<bigint>, marks binary")


def prefix_postings(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """``token, rep``: documents under the tokens of their prefixes, without tokens that one document has alone."""
    tokens = rows.join(reps.select(F.col("rep").alias("id")), "id", "left_semi").select(
        F.col("id").alias("rep"), F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("docs")).filter("docs > 1")
    held = tokens.join(shared, "token").groupBy("rep").agg(
        F.sort_array(F.collect_set(F.struct("docs", "token"))).alias("held"))
    keep = F.lit(COORDINATES - MATCHES + 1) - (F.lit(COORDINATES) - F.size("held"))
    return held.filter(keep > 0).select("rep", F.explode(F.slice("held", F.lit(1), keep)).alias("p")).select(
        F.col("p.token").alias("token"), "rep")


def blocks(postings: DataFrame) -> DataFrame:
    """``block, rep``: every document in the blocks of its postings, once each; lone postings have none."""
    least = postings.groupBy("token").agg(F.min("rep").alias("block"), F.max("rep").alias("high")).filter("block < high")
    return postings.join(least.select("token", "block"), "token").select("block", "rep").distinct()


def in_tiles(placed: DataFrame, held: DataFrame, column: str) -> DataFrame:
    """Rows of every block with ``held``'s ``column``, dealt by pairs of tiles and sorted. ``placed`` has ``n``."""
    totals = placed.groupBy("block").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    spread = placed.join(totals, "block").withColumn("tile", tile).join(held.select("rep", column), "rep").select(
        "block", "tile", "rep", "n", column, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    return spread.select("block", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"),
                         "tile", "rep", "n", column).repartition("block", "one", "two").sortWithinPartitions(
                             "block", "one", "two", "rep", column)


def promising(placed: DataFrame, marked: DataFrame) -> DataFrame:
    """The rows of ``placed`` that have a partner in their block with enough collisions and a fitting size."""

    def count(batches):
        for table in whole_runs(batches):
            block, rep, n = (table.column(c).to_numpy() for c in ("block", "rep", "n"))
            tile, one, two = (table.column(c).to_numpy() for c in ("tile", "one", "two"))
            marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            kept, first = np.zeros(len(table), bool), [*starts(table).tolist(), len(table)]
            for a, b in zip(first, first[1:], strict=False):
                for x in range(a, b):
                    # the block's own document comes first and settles most of a group at once
                    if kept[x] and x > a:
                        continue
                    may = (marks[a:b] == marks[x]).sum(axis=1) >= MATCHES
                    may &= (np.minimum(n[a:b], n[x]) * 100 >= np.maximum(n[a:b], n[x]) * PERCENT) & (rep[a:b] != rep[x])
                    if one[a] != two[a]:
                        may &= tile[a:b] != tile[x]
                    if may.any():
                        kept[x] = True
                        kept[a:b] |= may
            yield pa.record_batch([pa.array(block[kept]), pa.array(rep[kept]), pa.array(n[kept])],
                                  names=["block", "rep", "n"])

    return in_tiles(placed, marked, "marks").mapInArrow(count, "block bigint, rep bigint, n bigint").distinct()


def links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: confirmed links that join the documents of every block into their groups."""
    def link(batches):
        for table in whole_runs(batches):
            found = []
            for run in cut_runs(table.filter(pa.array(fresh(table, ["block", "one", "two", "rep"])))):
                found += groups_of(run)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return in_tiles(placed, sets, "shingles").mapInArrow(link, "a bigint, b bigint")


def fresh(table: pa.Table, names: list[str]) -> np.ndarray:
    """Which sorted rows differ from the one before in ``names``."""
    out = np.zeros(len(table), bool)
    out[:1] = True
    for name in names:
        column = table.column(name).to_numpy()
        out[1:] |= column[1:] != column[:-1]
    return out


def starts(table: pa.Table) -> np.ndarray:
    """Where a (block, one, two) begins in sorted rows."""
    return np.flatnonzero(fresh(table, ["block", "one", "two"]))


def whole_runs(batches):
    """Tables of sorted rows in which every (block, one, two) is complete; such a run is at most two tiles."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        if len(held):
            cut = int(starts(held)[-1])
            if cut:
                yield held.slice(0, cut)
                held = held.slice(cut)
    if held is not None and len(held):
        yield held


def cut_runs(table: pa.Table):
    """(ids, tile per row or None if all tiles are one, shingles, offsets) of every run with at least two documents."""
    first = [*starts(table).tolist(), len(table)]
    column = table.column("shingles").combine_chunks()
    values = column.values.to_numpy().view(np.uint64)
    offsets = column.offsets.to_numpy().astype(np.int64)
    ids, tile = table.column("rep").to_numpy(), table.column("tile").to_numpy()
    one, two = table.column("one").to_numpy(), table.column("two").to_numpy()
    for a, b in zip(first, first[1:], strict=False):
        if b - a > 1:
            yield (ids[a:b], tile[a:b] if one[a] != two[a] else None, values[offsets[a]:offsets[b]],
                   offsets[a:b + 1] - offsets[a])


def groups_of(run) -> list[tuple[int, int]]:
    """Confirmed links that join the documents of a run into groups. Every pair of documents that end in different
    groups has been looked at."""
    ids, tile, values, offsets = run
    count, n = len(ids), np.diff(offsets)
    signature = signatures(values, offsets)
    shared, local = np.unique(values, return_inverse=True)
    group, seen, out = np.arange(count), np.zeros(count, bool), []
    marked = np.zeros(len(shared), np.int64)

    def compare(x: int) -> None:
        seen[x] = True
        may = (group != group[x]) & (np.minimum(n, n[x]) * 100 >= np.maximum(n, n[x]) * PERCENT)
        if tile is not None:
            may &= tile != tile[x]
        at = np.flatnonzero(may)
        at = at[(signature[at] == signature[x]).sum(axis=1) >= MATCHES]
        if not len(at):
            return
        own = local[offsets[x]:offsets[x + 1]]
        marked[own] = 1
        slots, bounds = gather(local, offsets, at)
        both = np.add.reduceat(marked[slots], bounds[:-1])
        marked[own] = 0
        for y in at[both * 100 >= (n[x] + n[at] - both) * PERCENT].tolist():
            if group[y] != group[x]:
                out.append((int(ids[x]), int(ids[y])))
                group[group == group[y]] = group[x]

    for x in np.unique(np.linspace(0, count - 1, min(CENTRES, count)).astype(np.int64)).tolist():
        compare(x)
    largest = np.bincount(group).argmax()
    for x in np.flatnonzero(group != largest).tolist():
        if not seen[x]:
            compare(x)
    return out


def full_sets(docs: DataFrame, wanted: DataFrame, size: int, text: str, key: str) -> DataFrame:
    """``rep, shingles`` of the documents in ``wanted`` (a stored table of ids), from their texts."""

    def build(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                values, offsets = shingle_sets(rows.column(1), size)
                yield pa.record_batch([rows.column(0), pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))], names=["rep", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("rep"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    few = wanted.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(wanted) if few else wanted, "rep", "left_semi").mapInArrow(
        build, "rep bigint, shingles array<bigint>")


def near_duplicates(docs: DataFrame, size: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row ``key, n_shingles, component_id`` (smallest id reachable by links) and ``kept``."""
    rows = materialize(signed(docs, size, text, key), "signatures")
    several = rows.filter("same IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(
        F.min("same").alias("low"), F.max("same").alias("high")).filter("low <> high")
    if several.limit(1).count():
        return by_rows(docs, rows, size, text, key)
    reps = materialize(rows.filter("same IS NOT NULL AND id IS NOT NULL").groupBy("same").agg(
        F.min("id").alias("rep")), "sets")
    marked = rows.filter("same IS NOT NULL").select(F.col("id").alias("rep"), "n", "marks")
    placed = materialize(blocks(prefix_postings(rows, reps)).join(marked.select("rep", "n"), "rep").distinct(), "placed")
    placed = materialize(promising(placed, marked), "promising")
    wanted = materialize(placed.select("rep").distinct(), "wanted")
    sets = materialize(full_sets(docs, wanted, size, text, key), "shingles")
    groups = components(materialize(links(placed, sets), "links"))
    member = rows.select("id", "n", "same").join(reps, "same", "left").join(
        groups.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "rep", "id"))
    return member.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def by_rows(docs: DataFrame, rows: DataFrame, size: int, text: str, key: str) -> DataFrame:
    """``near_duplicates`` of a table in which an id stands on rows with different sets."""
    numbered = materialize(docs.filter(F.col(key).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(text).alias("text")), "rows")
    found = near_duplicates(numbered, size, "text", "row").withColumnRenamed("component_id", "part")
    found = materialize(found.select("row", "n_shingles", "part").join(numbered.select("row", "id"), "row"), "row_parts")
    first = found.groupBy("id").agg(F.min("part").alias("least"))
    joined = components(found.join(first, "id").select("part", "least"), "part", "least").select(
        F.col("id").alias("part"), F.col("component_id").alias("whole"))
    whole = found.join(joined, "part", "left").select("id", "n_shingles", F.coalesce("whole", "part").alias("whole"))
    least = whole.groupBy("whole").agg(F.min("id").alias("component_id"))
    out = whole.join(least, "whole").select(F.col("id").alias(key), "n_shingles", "component_id",
                                            (F.col("id") == F.col("component_id")).alias("kept"))
    return out.unionByName(rows.filter("id IS NULL").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept")))
