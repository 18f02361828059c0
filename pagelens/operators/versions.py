"""Page version snapshots: history, retention, timestamps, snapshot, rollback.

Snapshots are rows keyed by (page_id, version = epoch second of the save).
History and retention are per-page windows (partitioned by page, so every
page's snapshots sort independently); snapshot and rollback are set-at-a-time
joins of a request batch to the posts, meta and version tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.common import col, falsy
from pagelens.operators.seo import load_postmeta

VERSION_KEY_PREFIX = "_echo5_version_"
VERSION_COUNT_KEY = "_echo5_version_count"

# SEO meta keys captured in a snapshot (reference order).
SNAPSHOT_META_KEYS = (
    "rank_math_title", "rank_math_description", "rank_math_focus_keyword", "rank_math_canonical_url",
    "rank_math_facebook_title", "rank_math_facebook_description", "rank_math_facebook_image",
    "rank_math_twitter_title", "rank_math_twitter_description",
    "_yoast_wpseo_title", "_yoast_wpseo_metadesc", "_yoast_wpseo_focuskw", "_yoast_wpseo_canonical",
    "_yoast_wpseo_opengraph-title", "_yoast_wpseo_opengraph-description", "_yoast_wpseo_opengraph-image",
    "_yoast_wpseo_twitter-title", "_yoast_wpseo_twitter-description",
    "_aioseo_title", "_aioseo_description", "_aioseo_keywords",
    "_seopress_titles_title", "_seopress_titles_desc", "_seopress_analysis_target_kw",
    "_genesis_title", "_genesis_description", "focus_keyword",
    "_echo5_seo_title", "_echo5_seo_description", "_echo5_focus_keyword", "_echo5_canonical",
)


def iso_time(epoch_seconds) -> Column:
    """ISO-8601 with offset, as PHP date('c') prints it in UTC."""
    ts = F.timestamp_seconds(col(epoch_seconds))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def version_timestamp(meta_key) -> Column:
    """Epoch seconds in ``_echo5_version_<epoch>`` -> ISO time (NULL for other keys)."""
    digits = F.regexp_extract(col(meta_key), r"_echo5_version_(\d+)", 1)
    return F.when(digits != "", iso_time(digits.cast("bigint")))


def version_history(versions: DataFrame) -> DataFrame:
    """Per page: snapshots newest first with ISO time and stored length (bytes)."""
    w = Window.partitionBy("page_id").orderBy(F.col("version").desc())
    return versions.select("page_id", "version", iso_time(F.col("version")).alias("timestamp"),
                           F.octet_length("content").cast("bigint").alias("content_length"),
                           F.row_number().over(w).alias("rank"))


def version_retention(versions: DataFrame, keep: int = 10, compat: bool = False) -> DataFrame:
    """Snapshots kept by cleanup: newest ``keep`` per page.

    ``compat=True`` reproduces the reference, whose key pattern also matches
    the version-count key; that key sorts first and takes one of the places,
    so only ``keep - 1`` snapshots stay.
    """
    n = keep - 1 if compat else keep
    w = Window.partitionBy("page_id").orderBy(F.col("version").desc())
    return versions.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def _meta_map(postmeta: DataFrame, keys=SNAPSHOT_META_KEYS) -> DataFrame:
    """post_id -> MAP of non-empty snapshot meta values (first value per key)."""
    pm = load_postmeta(postmeta, keys).filter(F.col("meta_value").isNotNull() & (F.col("meta_value") != ""))
    return pm.groupBy("post_id").agg(F.map_from_entries(F.collect_list(F.struct("meta_key", "meta_value")))
                                     .alias("seo_meta"))


def snapshot_versions(updates: DataFrame, posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Snapshot rows taken before updating existing pages.

    ``updates`` has (page_id, saved_at). One snapshot per (page, epoch second):
    same-second saves overwrite, the last request (by saved_at, request_id)
    wins. Snapshot = current content, title and non-empty SEO meta.
    """
    u = (updates.select("page_id", "request_id", F.unix_timestamp(F.col("saved_at").cast("timestamp")).alias("version"))
         .groupBy("page_id", "version").agg(F.max("request_id").alias("request_id")))
    p = posts.select(F.col("id").alias("page_id"), F.col("post_content").alias("content"), "post_title")
    m = _meta_map(postmeta).withColumnRenamed("post_id", "page_id")
    return (u.join(p, "page_id").join(m, "page_id", "left")
            .select("page_id", "version", "request_id", "content", "post_title",
                    F.coalesce("seo_meta", F.create_map().cast("map<string,string>")).alias("seo_meta")))


def rollback(requests: DataFrame, posts: DataFrame, versions: DataFrame) -> DataFrame:
    """Restore content/title/meta of a stored version, per request.

    ``versions`` rows: (page_id, version, content, post_title, seo_meta_json,
    legacy_format). Legacy snapshots hold only the raw content. Status is
    ``not_found`` (no page/post), ``version_not_found`` or ``rolled_back``.
    """
    p = (posts.filter(F.col("post_type").isin("page", "post"))
         .select(F.col("id").alias("page_id"), F.col("post_title").alias("current_title"),
                 F.col("post_content").alias("current_content")))
    v = versions.select("page_id", "version", F.col("content").alias("v_content"),
                        F.col("post_title").alias("v_title"), "seo_meta_json", "legacy_format")
    j = requests.join(p, "page_id", "left").join(v, ["page_id", "version"], "left")
    found_page = F.col("current_content").isNotNull() | F.col("current_title").isNotNull()
    found_ver = F.col("v_content").isNotNull() & ~falsy(F.col("v_content"))
    status = (F.when(~found_page, F.lit("not_found")).when(~found_ver, F.lit("version_not_found"))
              .otherwise(F.lit("rolled_back")))
    ok = status == "rolled_back"
    legacy = F.coalesce(F.col("legacy_format"), F.lit(False))
    meta = F.from_json(F.col("seo_meta_json"), "map<string,string>")
    restored_meta = F.when(ok & ~legacy & (F.size(F.coalesce(meta, F.create_map())) > 0), meta)
    return j.select(
        "request_id", "page_id", "version", status.alias("status"),
        F.when(ok, F.col("v_content")).alias("content"),
        F.when(ok, F.when(legacy, F.col("current_title")).otherwise(F.coalesce("v_title", "current_title")))
         .alias("post_title"),
        restored_meta.alias("seo_meta"),
        (restored_meta.isNotNull()).alias("seo_meta_restored"),
    )
