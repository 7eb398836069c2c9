"""The corpus pipeline: toxic documents go, of near copies one stays, secrets are masked, what is left is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``, whatever they are; columns that are not needed pass
through untouched.

Cases: a NULL or empty text is judged as empty, is no near copy of anything, holds no secret and packs as its end id; a
NULL id is kept as a document of its own; repeated rows (equal id and text) count as copies, one stays; an empty table
passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.minhash import near_duplicates
from faultline.llm.packing import pack_documents
from faultline.llm.secrets import MASKED, masked, scan
from faultline.llm.tables import table, vocabulary
from faultline.llm.toxicity import keep_clean, learn
from faultline.session import materialize, run_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels that are not held out."""
    return keep_clean(docs, learn(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, similarity 0.8): the one with the smallest id."""
    kept = near_duplicates(docs, size=5).filter("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("doc_id")).distinct()
    known = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return known.unionByName(docs.filter("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark, private keys with their body; the length follows the text."""
    names = docs.columns
    found = scan(docs.select(F.struct(*names).alias("__document"), F.col("text").alias("text")), run_dir(spark, "ledger"),
                 rules=MASKED)
    held = F.array_size("found") > 0
    text = masked(F.col("__document.text"), F.col("found"))
    out = found.select(*[F.col(f"__document.`{name}`") for name in names], held.alias("__held"), text.alias("__text"))
    changed = {"text": F.when(F.col("__held"), F.col("__text")).otherwise(F.col("text"))}
    if "n_chars" in names:
        changed["n_chars"] = F.when(F.col("__held"), F.length("__text").cast("long")).otherwise(F.col("n_chars"))
    return out.select(*[changed.get(name, F.col(f"`{name}`")).alias(name) for name in names])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=0)


STAGES = [("toxicity", drop_toxic), ("minhash", drop_near_copies), ("secrets", mask_secrets), ("packing", pack)]
#: The first stage learns weights, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
