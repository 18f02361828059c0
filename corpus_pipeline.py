"""From raw documents to tokens: five stages, each on all that the one before has kept.

Every stage calls one operator of ``pagelens.llm`` and takes (spark, docs, sf_dir). All
but the last return the columns of ``docs``; the last returns the token ids of each
document and the text that they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm.bpe import encode
from pagelens.llm.common import table
from pagelens.llm.decontaminate import decontaminate
from pagelens.llm.line_dedup import dedup_lines
from pagelens.llm.quality import learned, quality
from pagelens.llm.simhash import keep_one


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated probability of good quality is one half or more; null and empty texts are scored like any other."""
    scored = quality(docs, table(spark, sf_dir, "labels"), learned)
    return scored.filter(F.col(scored.columns[-1]) >= 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of lines that stand in an earlier one; n_chars follows the text (null texts keep theirs)."""
    out = dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints: the one of the smallest doc_id."""
    return keep_one(docs).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten benchmark words."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of every document."""
    import public_tokenizers
    out = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: A trained classifier and byte-pair merges are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
