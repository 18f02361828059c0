"""Tables whose columns have the names that operators might use for themselves."""

import corpus_pipeline
import pytest
from pagelens.llm import decontaminate, language, line_dedup, quality, resampling, simhash
from pagelens.llm.common import free
from pyspark.sql import functions as F

NAMES = ["__key", "__KEPT", "__dirty", "__score", "__gone", "__spans", "_key", "key", "kept", "dirty", "id", "_id", "_first", "_root", "_n", "score", "spans", "row", "gone", "unit", "lost", "label", "quality", "_text", "fp"]
TEXT = "one two three four five six seven eight nine ten eleven"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(["fine words here", TEXT, TEXT + " twelve", "fine words here", None, "", "a\nb c\nd e"])] + [(1, TEXT), (None, None), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES])


def test_names_are_drawn_whatever_the_case(spark):
    assert free(spark.range(1).selectExpr("1 AS KEY", "2 AS _key"), "key", "key", "Id") == ["__key", "___key", "Id"]


def test_columns_come_back_as_they_were(spark, docs):
    items = spark.createDataFrame([(1, TEXT)], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    outs = {"decontaminate": decontaminate.decontaminate(docs, items), "keep_one": simhash.keep_one(docs), "lines": line_dedup.dedup_lines(docs),
            "quality": quality.quality(docs, labels, lambda i: F.lit(True)), "resample": resampling.resample(docs, items, percent=100, min_words=1)}
    for name, out in outs.items():
        assert out.columns[:len(docs.columns)] == docs.columns, name
        for r in out.collect():
            assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for n in NAMES), name
    assert sorted(str(r.doc_id) for r in outs["decontaminate"].select("doc_id").collect()) == ["0", "3", "4", "5", "6", "None", "None"]
    assert outs["keep_one"].count() == len({r.component_id for r in simhash.near_duplicates(docs).collect()})
    assert outs["quality"].count() == outs["lines"].count() == docs.count()


def test_stages_on_odd_rows_and_an_empty_table(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, int(i != 3), 0) for i in range(6)] + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, TEXT), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wide = docs.withColumns({"n_chars": F.length("text").cast("long"), "lang": F.lit("en"), "source": F.lit("s")})
    for table in (wide, wide.limit(0)):
        kept = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, kept, str(tmp_path))
            if name != "bpe_tokens":
                assert out.columns == kept.columns, name
                kept = out.checkpoint()
        assert out.count() == kept.count()


def test_a_text_without_letters_has_no_language(spark):
    rows = [(0, "bonjour le monde"), (1, "hello the world"), (2, "½ ² ① 12 _ !"), (3, "ª"), (5, "中")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.when(F.col("doc_id") == 0, "fr").when(F.col("doc_id") == 1, "en"))
    got = {r.doc_id: r.lang_pred for r in language.languages(df, lambda i: F.lit(True)).collect()}
    assert got[2] == language.UNKNOWN and language.UNKNOWN not in (got[3], got[5])
