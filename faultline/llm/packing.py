"""Best-fit packing by sums of squares: documents of token ids into as few fixed-size sequences as possible.

``token_pieces(docs, path, end_id)`` gives the pieces of every document: its ids and the end id, whole if they fit, else cut
into pieces of ``capacity`` of which the last may be shorter. ``pack(pieces)`` gives each piece a sequence and an offset.

Method: pieces are placed from long to short. The state is N(g), the number of open sequences with g places left. A piece
of length s goes where the sum of N(g) squared becomes smallest: moving a sequence from gap g to g - s changes the sum
by 2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(s) when it is filled up. A new sequence is opened only when no open one has
room. Rows that fill a sequence alone never enter the state.

Pieces are dealt at random, by a hash of their place in the stored table, into shards of about ``SHARD`` pieces, whatever
their source, id or text, so that equal rows part too, and each shard packs alone: memory is bounded by the shard, a shard ends with about one sequence that is not full, and a lost task repeats one
shard. Only lengths are moved, never texts or ids.

Cases: a NULL or empty text is a document of the end id alone; rows with equal ids are packed each; an empty table gives
an empty result; a document of any length gives as many pieces as it needs; ties between gaps go to the smaller gap,
between sequences to the older; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes, encode, small_batches
from faultline.session import materialize

CAPACITY = 2048
SHARD = 8192
SLICE_BYTES = 4 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """Pieces of all documents, with the checksum of their ids as little-endian 32-bit integers."""

    def cut(batches):
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                ids, offsets = encode(rows.column(1), path)
                ids = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
                opens = offsets[:-1] + np.arange(len(rows))
                sizes = np.diff(offsets) + 1
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(rows)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                view, at = memoryview(ids), (opens[row] + start)
                crc = [zlib.crc32(view[a:a + n]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                yield pa.record_batch([rows.column(0).take(pa.array(row)), pa.array(piece, pa.int32()),
                                       pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return small_batches(rows).mapInArrow(cut, PIECES)


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, taken in the order given."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    sequence, offset, used = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for n, size in enumerate(lengths.tolist()):
        if size == capacity:
            sequence[n], used = used, used + 1
            continue
        left = np.flatnonzero(count[size:])
        if len(left):
            change = 2 * (count[left] - count[left + size]) + 2
            if left[0] == 0:
                change[0] = 1 - 2 * count[size]
            after = int(left[change.argmin()])
            gap = after + size
            which = open_at[gap].pop(0)
            count[gap] -= 1
        else:
            which, used, gap, after = used, used + 1, capacity, capacity - size
        sequence[n], offset[n] = which, capacity - gap
        if after:
            open_at[after].append(which)
            count[after] += 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``pieces`` (columns of ``PIECES``) with ``sequence_id`` and ``offset``. They are read twice, and a row's place among the
    files decides its shard: pass a stored table."""
    shards = max(1, -(-pieces.count() // shard))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable")
        sequence, offset = place(group["length"].to_numpy(), capacity)
        group["sequence_id"] = group["__shard"].astype("int64") * (1 << 32) + sequence
        group["offset"] = offset
        return group.drop(columns="__shard")

    place_in_table = F.struct(F.monotonically_increasing_id())
    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64(place_in_table, F.lit(7)), F.lit(shards)).cast("int"))
    return dealt.groupBy("__shard").applyInPandas(fill, f"{PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Pieces of all documents with their places; the pieces are stored once in between."""
    return pack(materialize(token_pieces(docs, path, end_id, capacity), "pieces"), capacity, shard)
