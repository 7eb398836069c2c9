import pytest
from pyspark.sql import functions as F

LONG = ("lorem ipsum " * 9000) + "ünïcode 日本語 😀 " * 50
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, LONG), (5, "Ünïcode ΣΑΣ 日本語 😀 it's 'LL 2024"), (None, "one two three four"),
       (7, "the same words in the same order and a few more of them"), (8, "the same words in the same order and a few more of them"),
       (9, " \n\t "), (10, "x" * 5000), (11, "<|endoftext|> and <|startoftext|> inside"), (12, "two  spaces\n\nand lines ")]
CLASH = ["id", "rep", "token", "n", "vec", "score", "n_tokens", "kept", "sequence_id", "same", "found", "blob", "row", "range"]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with NULLs, empty, repeated and very long texts, and extra columns whose names the operators use inside."""
    frame = spark.createDataFrame(ODD, "doc_id bigint, text string")
    frame = frame.withColumns({name: F.lit(f"clash {name}") for name in CLASH})
    return frame.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"),
                              "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def none(odd):
    """The same table without rows."""
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
