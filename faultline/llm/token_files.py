"""Token-ID output: texts as ids in files of Simple-8b blocks, in ascending order of the document id.

``write_tokens(docs, path, tokenizer)`` writes, ``read_tokens(spark, path)`` reads back.

Format: a folder of Parquet files written by Spark (so that a lost executor or a repeated task leaves no half file). A row
is a block: ``part``, ``block`` (number within the part), ``first_id``, ``n_ids``, ``start`` (ids of the part before
the block), ``doc_ids``, ``ends`` (where each document ends in the block) and ``words`` (little-endian 64-bit Simple-8b
words). A block holds whole documents, about ``BLOCK_IDS`` ids; a longer document has a block of its own. Parts are ranges
of the document id, in order of ``first_id``; the manifest that places them is one row per part.

One shuffle: texts are dealt by ranges of the id and sorted; everything else happens in the task that holds a range.

Cases: a NULL text is the empty text, whose ids are the end id alone; rows with equal ids are kept and lie in the order
of their texts; a NULL id comes first; an empty table gives no files and an empty result; a text of any length is one
document; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import simple8b
from faultline.llm.chunks import by_bytes, encode, small_batches

BLOCK_IDS = 1 << 17
SLICE_BYTES = 6 << 20
BLOCKS = ("part int, block int, first_id bigint, start bigint, n_ids bigint, doc_ids array<bigint>, ends array<int>, "
          "words binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id",
                 block_ids: int = BLOCK_IDS) -> None:
    """Blocks of all of ``docs`` written to the folder ``path``."""

    def block_of(part, number, start, keys, pieces):
        ids = np.concatenate(pieces)
        ends = np.cumsum([len(p) for p in pieces])
        return pa.RecordBatch.from_pylist([{
            "part": part, "block": number, "first_id": keys[0], "start": start, "n_ids": len(ids), "doc_ids": keys,
            "ends": ends.tolist(), "words": simple8b.pack(ids).astype("<u8").tobytes()}], schema=layout)

    layout = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("start", pa.int64()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())),
                        ("words", pa.binary())])

    def write(batches):
        from pyspark import TaskContext
        part, number, start, keys, pieces, held = TaskContext.get().partitionId(), 0, 0, [], [], 0
        for batch in batches:
            for rows in by_bytes(batch, "text", SLICE_BYTES):
                ids, offsets = encode(rows.column(1), tokenizer)
                for n, doc_id in enumerate(rows.column(0).to_pylist()):
                    if held >= block_ids:
                        yield block_of(part, number, start, keys, pieces)
                        number, start, keys, pieces, held = number + 1, start + held, [], [], 0
                    keys.append(doc_id)
                    pieces.append(np.append(ids[offsets[n]:offsets[n + 1]], np.uint32(end_id)))
                    held += len(pieces[-1])
        if keys:
            yield block_of(part, number, start, keys, pieces)

    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    small_batches(ordered).mapInArrow(write, BLOCKS).write.option("compression", "none").parquet(path)


def starts_of_parts(blocks: DataFrame) -> DataFrame:
    """One row per part: the ids of all parts before it. Parts are as many as tasks of the writing stage."""
    from pyspark.sql import Window
    parts = blocks.groupBy("part").agg(F.min("first_id").alias("opens"), F.sum("n_ids").alias("ids"))
    before = Window.orderBy(F.col("opens").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``), decoded from the blocks of ``path``."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def decode(batches):
        for batch in batches:
            for row in range(len(batch)):
                base, first = batch.column("base")[row].as_py(), batch.column("start")[row].as_py()
                doc_ids, ends = batch.column("doc_ids")[row].values, batch.column("ends")[row].values.to_numpy()
                words = np.frombuffer(batch.column("words")[row].as_buffer(), "<u8")
                ids = simple8b.unpack(words, batch.column("n_ids")[row].as_py()).astype("<u4")
                opens = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                view = memoryview(ids)
                crc = [zlib.crc32(view[a:b]) for a, b in zip(opens.tolist(), ends.tolist(), strict=True)]
                out = [doc_ids, pa.array(base + first + opens), pa.array(ends - opens, pa.int64()),
                       pa.array(crc, pa.int64())]
                if with_ids:
                    bounds = pa.array(np.append(opens, ends[-1]), pa.int32())
                    out.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int64))))
                yield pa.record_batch(out, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    placed = blocks.join(F.broadcast(starts_of_parts(blocks)), "part")
    return placed.select("base", "start", "n_ids", "doc_ids", "ends", "words").mapInArrow(decode, schema)
