"""Token counts: batches of texts go through an Arrow function that returns lengths only.

``token_counts(docs, path)`` returns ``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

Batches hold about the same number of bytes, whatever the number of rows; a long text is cut where the cut cannot change
a token (see ``chunks``), so that no call of the library gets a text whole that could be cut. There is no shuffle: rows
are counted where they are read.

Cases: a NULL text counts as the empty text (0 bytes, 0 tokens); a NULL id is kept; repeated rows are counted each; an
empty table gives an empty result; other columns of ``docs``, whatever their names, are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.chunks import by_bytes, lengths

LIMIT = 4096


def token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every text, and whether there are more tokens than ``limit``."""
    kind = docs.schema[key].dataType.simpleString()

    def count(batches):
        for batch in batches:
            for part in by_bytes(batch, "text"):
                yield pa.record_batch([part.column(0), part.column(1), pa.array(lengths(part.column(2), path))],
                                      names=["id", "n_bytes", "n_tokens"])

    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
