"""The registered queries of this subpackage, each over a whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm.fingerprints import neighbours
from faultline.llm.licenses import scan_licenses
from faultline.llm.metric_join import near_vectors
from faultline.llm.minhash import near_duplicates
from faultline.llm.packing import pack_documents
from faultline.llm.quality import quality_report
from faultline.llm.secrets import SQL as SECRETS_SQL
from faultline.llm.secrets import secret_report
from faultline.llm.spelling import spelling_variants, word_counts
from faultline.llm.tables import table, vocabulary
from faultline.llm.token_counts import token_counts
from faultline.llm.token_files import read_tokens, write_tokens
from faultline.llm.toxicity import learn, score
from faultline.llm.transducer import code_texts
from faultline.llm.whitening import whitened_rows
from faultline.session import run_dir


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token_files")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path)


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents"))


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=0)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_texts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(table(spark, sf_dir, "embeddings"))


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


QUERIES = {
    "op1_token_files": token_files,
    "op2_fingerprints": fingerprints,
    "op3_metric_join": near_embeddings,
    "op4_packing": packing,
    "op5_secrets": secrets,
    "op6_minhash": near_documents,
    "op7_bpe": bpe,
    "op8_toxicity": toxicity,
    "op9_token_counts": counts,
    "op10_licenses": licenses,
    "op11_whitening": whitening,
    "op12_spelling": spelling,
    "op13_quality": quality,
}
ORACLES: dict[str, str] = {"op5_secrets": SECRETS_SQL}
