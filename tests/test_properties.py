"""Property tests on the given tables."""

from pyspark.sql import functions as F

from conftest import SMALL
from pagelens.operators import blocks as B
from pagelens.operators import export as X
from pagelens.operators import versions as V
from pagelens.sources.tables import Tables


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_block_dedup_idempotent(spark):
    t = Tables(spark, SMALL)
    once = B.block_dedup(B.block_filters(B.block_rows(B.html_tokens(t.pages)), False))
    twice = B.block_dedup(once)
    assert _rows(once) == _rows(twice)


def test_internal_plus_external_is_all_links(spark):
    t = Tables(spark, SMALL)
    p = t.enriched_pages
    counts = X.link_counts(p).select("page_id", (F.col("internal_count") + F.col("external_count")).alias("n"))
    links = X.page_links(p).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(links, "page_id", "left").select(
        "page_id", counts["n"].alias("a"), F.coalesce(links["n"], F.lit(0)).alias("b"))
    assert joined.filter(F.col("a") != F.col("b")).count() == 0


def test_rollback_of_snapshot_restores_page(spark):
    t = Tables(spark, SMALL)
    posts = t.posts
    pages = posts.filter(F.col("post_type").isin("page", "post")).select(F.col("id").alias("page_id"))
    updates = pages.select("page_id", F.col("page_id").alias("request_id"),
                           F.lit("2024-05-01 12:00:00").cast("timestamp").alias("saved_at"))
    snap = V.snapshot_versions(updates, posts, t.postmeta)
    versions = snap.select("page_id", "version", "content", "post_title",
                           F.to_json("seo_meta").alias("seo_meta_json"), F.lit(False).alias("legacy_format"))
    reqs = snap.select("request_id", "page_id", "version")
    back = V.rollback(reqs, posts, versions)
    orig = posts.select(F.col("id").alias("page_id"), F.col("post_content").alias("c0"),
                        F.col("post_title").alias("t0"))
    j = back.join(orig, "page_id")
    assert j.count() == pages.count() > 0
    assert j.filter((F.col("status") != "rolled_back") | (F.col("content") != F.col("c0"))
                    | (F.col("post_title") != F.col("t0"))).count() == 0
