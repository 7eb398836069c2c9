import json

import pytest
from faultline.operators.conform import check_dim, conform
from faultline.operators.corpus import MODE_RULES, exclude, measure_for, number_rows, uniqueness
from faultline.operators.models import ModelSpec, letter_counts
from faultline.schemas import MANUAL
from faultline.sources.corpus import assemble, extra_sections, fingerprint, read_corpus, seed_corpus
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = ModelSpec("letters", "ARRAY<FLOAT>", letter_counts, backoff_s=0.0)


def table(spark):
    return spark.sql("SELECT 7L AS id, 'covered by a 24-month warranty' AS content, 'warranty' AS category, "
                     "array(0.1f, 0.2f, 0.3f) AS vec")


def declared(text):
    return T.StructType.fromDDL(text)


def test_conform_casts_by_name_and_keeps_declared_order(spark):
    done = conform(table(spark), declared("vec ARRAY<DOUBLE>, category STRING, id INT, content DOUBLE"), "id")
    assert done.columns == ["vec", "category", "id", "content"]
    assert done.first().content is None and done.schema["vec"].dataType == T.ArrayType(T.DoubleType())


@pytest.mark.parametrize("kind", ["MAP<STRING,STRING>", "DECIMAL(10,2)", "TIMESTAMP", "STRUCT<a: INT>", "ARRAY<BOOLEAN>"])
def test_conform_rejects_other_types_naming_the_column(spark, kind):
    with pytest.raises(ValueError, match="'meta'"):
        conform(table(spark), declared(f"meta {kind}, vec ARRAY<FLOAT>"), "id")


def test_conform_needs_a_vector_and_all_columns(spark):
    with pytest.raises(ValueError, match="ARRAY"):
        conform(table(spark), declared("id BIGINT, content STRING"), "id")
    with pytest.raises(ValueError, match="severity, section"):
        conform(table(spark), declared("id BIGINT, severity INT, section STRING, vec ARRAY<FLOAT>"), "id")
    renamed = conform(table(spark), declared("section_id BIGINT, content STRING, vec ARRAY<FLOAT>"), "id")
    assert renamed.first().section_id == 7


def test_present_null_stays_null(spark):
    df = table(spark).withColumn("category", F.lit(None).cast("string"))
    assert conform(df, declared("id BIGINT, category STRING, vec ARRAY<FLOAT>"), "id").first().category is None


def test_dimension_check(spark):
    assert check_dim(table(spark), "vec", 3).count() == 1
    with pytest.raises(ValueError, match="declared dimension 4"):
        check_dim(table(spark), "vec", 4)
    mixed = table(spark).unionByName(table(spark).withColumn("vec", F.array(F.lit(1.0).cast("float"))))
    with pytest.raises(ValueError, match="1 to 3"):
        check_dim(mixed, "vec", 3)


def test_extra_sections(spark, tmp_path):
    path = tmp_path / "extra.json"
    path.write_text(json.dumps([["text one", "thermal", "Title", "SM-11.1", 2], ["text two", "safety", "Other", "SM-11.2", 4]]))
    rows = extra_sections(spark, str(path)).orderBy("ord").collect()
    assert [(r.content, r.section, r.severity, r.ord) for r in rows] == [
        ("text one", "Title", 2, 0), ("text two", "Other", 4, 1)]
    assert extra_sections(spark, str(path), enabled=False).count() == 0
    assert extra_sections(spark, str(tmp_path / "none.json")).count() == 0


def sections(spark, titles):
    return spark.createDataFrame(
        [(f"about {t}", "thermal", t, f"SM-{t}", 1, i) for i, t in enumerate(titles)],
        "content STRING, category STRING, section STRING, doc_ref STRING, severity INT, ord BIGINT")


def test_seeding_numbers_embeds_and_skips(spark, tmp_path):
    path = str(tmp_path / "manual")
    whole = assemble(sections(spark, "cab"), sections(spark, "xy"))
    assert seed_corpus(whole, path, LETTERS, 26)
    manual = read_corpus(spark, path)
    assert manual.schema.names == MANUAL.names
    assert [(r.id, r.section) for r in manual.orderBy("id").collect()] == list(enumerate("cabxy"))
    assert fingerprint(spark, path) == "letters@26"
    assert not seed_corpus(whole, path, LETTERS, 26)
    other = ModelSpec("letters-2", "ARRAY<FLOAT>", letter_counts)
    assert seed_corpus(whole, path, other, 26) and fingerprint(spark, path) == "letters-2@26"
    assert read_corpus(spark, path).count() == 5


def test_seeding_refuses_a_wrong_width_or_a_failed_call(spark, tmp_path):
    path = str(tmp_path / "manual")
    with pytest.raises(ValueError, match="declared dimension 8"):
        seed_corpus(assemble(sections(spark, "a"), sections(spark, "b")), path, LETTERS, 8)

    def down(_):
        def call(chunk):
            raise OSError("down")
        return call
    with pytest.raises(ValueError, match="down"):
        seed_corpus(assemble(sections(spark, "a"), sections(spark, "b")), path,
                    ModelSpec("d", "ARRAY<FLOAT>", down, backoff_s=0.0), 26)
    assert fingerprint(spark, path) is None


def test_reading_for_probes_of_another_model_is_refused(spark, tmp_path):
    path = str(tmp_path / "manual")
    seed_corpus(assemble(sections(spark, "a"), sections(spark, "b")), path, LETTERS, 26)
    assert read_corpus(spark, path, model=LETTERS, dim=26).count() == 2
    with pytest.raises(ValueError, match="embedded by letters@26, the probes by letters-2@26"):
        read_corpus(spark, path, model=ModelSpec("letters-2", "ARRAY<FLOAT>", letter_counts), dim=26)


def test_a_seeding_that_breaks_off_is_not_taken_for_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "manual")
    seed_corpus(assemble(sections(spark, "a"), sections(spark, "b")), path, LETTERS, 26)
    other = ModelSpec("letters-2", "ARRAY<FLOAT>", letter_counts)
    more = assemble(sections(spark, "cab"), sections(spark, "xy"))

    def lost(*_, **__):
        raise OSError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(DataFrameWriter, "parquet", lost)
        with pytest.raises(OSError, match="lost"):
            seed_corpus(more, path, other, 26)
    assert fingerprint(spark, path) is None
    with pytest.raises(ValueError, match="no known model"):
        read_corpus(spark, path, model=LETTERS, dim=26)
    assert seed_corpus(more, path, LETTERS, 26) and read_corpus(spark, path, model=LETTERS, dim=26).count() == 5


def test_numbering_over_partitions(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("v")).repartition(7)
    assert all(r.id == r.v for r in number_rows(df, ["v"]).collect())


def test_uniqueness_finds_each_kind(spark):
    df = spark.createDataFrame(
        [(1, "use MK-1234 and MK-1234", "A", "r1"), (2, "fit MK-1234", "A", "r2"), (3, "fit HK-9", "B", "r2")],
        "id INT, content STRING, section STRING, doc_ref STRING")
    assert {tuple(r) for r in uniqueness(df).collect()} == {("section", "A", 2), ("doc_ref", "r2", 2), ("part", "MK-1234", 2)}


def test_exclusions(spark):
    df = spark.createDataFrame([("spindle", "bearing wear"), ("spindle", "noise"), ("crane hoist brake", "slip"),
                                ("area scanner", "contamination")], "component STRING, mode STRING")
    assert [tuple(r) for r in exclude(df, "component", "mode").collect()] == [("spindle", "noise")]


@pytest.mark.parametrize("mode,category,unit", [
    ("zone imbalance", "thermal", "bar"), ("insulation degradation", "electrical", "mm/s RMS"),
    ("grip loss", "mechanical", "Nm"), ("unheard of", "safety", "ms"), ("unheard of", "other", None)])
def test_first_rule_wins(spark, mode, category, unit):
    df = spark.createDataFrame([(mode, category)], "m STRING, c STRING")
    assert df.select(measure_for(F.col("m"), F.col("c"))["unit"].alias("u")).first().u == unit
    assert len(MODE_RULES) == 14
