"""SEO metadata: EAV postmeta -> wide rows, plugin detection, resolution.

Scale notes: ``postmeta`` is the largest table (many rows per post). It is
filtered to the needed keys at the scan (pushed-down ``IN``), aggregated once
per post (partial aggregation before the shuffle), then joined to posts on
the post id. Per-site plugin flags are one small row per site; the fixed
key-map table below is broadcast (its size is fixed by this file).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.functions.common import falsy
from pagelens.functions.url import url_host

# SEO plugins in detection order (first active one wins).
SEO_PLUGIN_ORDER = ("yoast", "rankmath", "aioseo", "seopress", "tsf")
GENERIC = "generic"

# Logical field -> meta key, per plugin (reference order).
META_KEYS = {
    "yoast": (
        ("title", "_yoast_wpseo_title"), ("description", "_yoast_wpseo_metadesc"),
        ("focus_keyword", "_yoast_wpseo_focuskw"), ("canonical", "_yoast_wpseo_canonical"),
        ("robots_noindex", "_yoast_wpseo_meta-robots-noindex"),
        ("robots_nofollow", "_yoast_wpseo_meta-robots-nofollow"),
        ("og_title", "_yoast_wpseo_opengraph-title"), ("og_description", "_yoast_wpseo_opengraph-description"),
        ("og_image", "_yoast_wpseo_opengraph-image"), ("twitter_title", "_yoast_wpseo_twitter-title"),
        ("twitter_description", "_yoast_wpseo_twitter-description"),
        ("twitter_image", "_yoast_wpseo_twitter-image"), ("schema", "_yoast_wpseo_schema_page_type"),
    ),
    "rankmath": (
        ("title", "rank_math_title"), ("description", "rank_math_description"),
        ("focus_keyword", "rank_math_focus_keyword"), ("canonical", "rank_math_canonical_url"),
        ("robots", "rank_math_robots"), ("og_title", "rank_math_facebook_title"),
        ("og_description", "rank_math_facebook_description"), ("og_image", "rank_math_facebook_image"),
        ("twitter_title", "rank_math_twitter_title"), ("twitter_description", "rank_math_twitter_description"),
        ("twitter_image", "rank_math_twitter_image"), ("schema", "rank_math_rich_snippet"),
    ),
    "aioseo": (
        ("title", "_aioseo_title"), ("description", "_aioseo_description"),
        ("focus_keyword", "_aioseo_keywords"), ("canonical", "_aioseo_canonical_url"),
        ("robots_noindex", "_aioseo_noindex"), ("robots_nofollow", "_aioseo_nofollow"),
        ("og_title", "_aioseo_og_title"), ("og_description", "_aioseo_og_description"),
        ("og_image", "_aioseo_og_image_custom_url"), ("twitter_title", "_aioseo_twitter_title"),
        ("twitter_description", "_aioseo_twitter_description"),
        ("twitter_image", "_aioseo_twitter_image_custom_url"),
    ),
    "seopress": (
        ("title", "_seopress_titles_title"), ("description", "_seopress_titles_desc"),
        ("focus_keyword", "_seopress_analysis_target_kw"), ("canonical", "_seopress_robots_canonical"),
        ("robots_noindex", "_seopress_robots_index"), ("robots_nofollow", "_seopress_robots_follow"),
        ("og_title", "_seopress_social_fb_title"), ("og_description", "_seopress_social_fb_desc"),
        ("og_image", "_seopress_social_fb_img"), ("twitter_title", "_seopress_social_twitter_title"),
        ("twitter_description", "_seopress_social_twitter_desc"),
        ("twitter_image", "_seopress_social_twitter_img"),
    ),
    "tsf": (
        ("title", "_genesis_title"), ("description", "_genesis_description"),
        ("canonical", "_genesis_canonical_uri"), ("robots_noindex", "_genesis_noindex"),
        ("robots_nofollow", "_genesis_nofollow"), ("og_title", "_open_graph_title"),
        ("og_description", "_open_graph_description"), ("twitter_title", "_twitter_title"),
        ("twitter_description", "_twitter_description"),
    ),
    "generic": (
        ("title", "_echo5_seo_title"), ("description", "_echo5_seo_description"),
        ("focus_keyword", "_echo5_focus_keyword"), ("canonical", "_echo5_canonical"),
        ("robots", "_echo5_robots"), ("og_title", "_echo5_og_title"),
        ("og_description", "_echo5_og_description"), ("og_image", "_echo5_og_image"),
        ("schema", "_echo5_schema"),
    ),
}
# Generic backup fields always read by get_all_meta.
BACKUP_FIELDS = (
    ("_echo5_seo_title", "echo5_title"), ("_echo5_seo_description", "echo5_description"),
    ("_echo5_focus_keyword", "echo5_focus_keyword"), ("_echo5_secondary_keywords", "echo5_secondary_keywords"),
)
MANAGED_KEY = "_echo5_seo_managed"
THUMBNAIL_KEY = "_thumbnail_id"
DEFAULT_ROBOTS = "index, follow"

# Keys read by the export-side resolution (Yoast, RankMath, AIOSEO).
RESOLVE_KEYS = (
    "_yoast_wpseo_title", "_yoast_wpseo_metadesc", "_yoast_wpseo_focuskw", "_yoast_wpseo_canonical",
    "_yoast_wpseo_opengraph-title", "_yoast_wpseo_opengraph-description", "_yoast_wpseo_opengraph-image",
    "_yoast_wpseo_twitter-title", "_yoast_wpseo_twitter-description", "_yoast_wpseo_twitter-image",
    "rank_math_title", "rank_math_description", "rank_math_focus_keyword", "rank_math_canonical_url",
    "rank_math_robots", "_aioseo_title", "_aioseo_description", "_aioseo_canonical_url",
)


def key_map_df(spark: SparkSession) -> DataFrame:
    """The fixed (plugin, field, meta_key) table (~70 rows; safe to broadcast)."""
    rows = [(p, f, k) for p, pairs in META_KEYS.items() for f, k in pairs]
    return spark.createDataFrame(rows, "plugin string, field string, meta_key string")


def load_postmeta(postmeta: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Single value per (post, key): the row with the smallest meta_id."""
    if keys:
        postmeta = postmeta.filter(F.col("meta_key").isin(*keys))
    return (postmeta.groupBy("post_id", "meta_key")
            .agg(F.min_by("meta_value", "meta_id").alias("meta_value")))


def meta_wide(postmeta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per post, one column per key (first value by meta_id; NULL if absent).

    A single aggregation: ``min_by(value, CASE key WHEN k THEN meta_id END)``
    per key, after a pushed-down ``meta_key IN (...)`` filter.
    """
    pm = postmeta.filter(F.col("meta_key").isin(*keys))
    aggs = [F.min_by("meta_value", F.when(F.col("meta_key") == k, F.col("meta_id"))).alias(k) for k in keys]
    return pm.groupBy("post_id").agg(*aggs)


def site_plugin_flags(site_plugins: DataFrame) -> DataFrame:
    """Per site: which SEO plugins are active (``has_<plugin>``) and the chosen one."""
    aggs = [F.bool_or(F.col("plugin") == p).alias(f"has_{p}") for p in SEO_PLUGIN_ORDER]
    flags = site_plugins.groupBy("site_id").agg(*aggs)
    chosen = F.lit(GENERIC)
    for p in reversed(SEO_PLUGIN_ORDER):
        chosen = F.when(F.coalesce(F.col(f"has_{p}"), F.lit(False)), F.lit(p)).otherwise(chosen)
    return flags.withColumn("seo_plugin", chosen)


def active_seo_plugin(posts: DataFrame, site_plugins: DataFrame) -> DataFrame:
    """Per post: the first active SEO plugin of its site, else ``generic``."""
    flags = site_plugin_flags(site_plugins).select("site_id", "seo_plugin")
    return (posts.select("id", "site_id").join(flags, "site_id", "left")
            .select(F.col("id").cast("bigint").alias("id"), "site_id",
                    F.coalesce("seo_plugin", F.lit(GENERIC)).alias("seo_plugin")))


def _empty(c: Column) -> Column:
    return falsy(c)


def _meta(c: str) -> Column:
    """get_post_meta(single) reads a missing key as ''."""
    return F.coalesce(F.col(f"`{c}`"), F.lit(""))


def seo_resolve(posts: DataFrame, postmeta: DataFrame, site_plugins: DataFrame,
                site_name: Column | None = None) -> DataFrame:
    """Resolved SEO fields per post (Yoast, then RankMath, then AIOSEO overwrite).

    Template titles (``%%`` for Yoast, ``%`` RankMath, ``#`` AIOSEO) and empty
    titles become ``post_title - site name``; the site name defaults to the
    host of the post url.
    """
    wide = meta_wide(postmeta, RESOLVE_KEYS)
    flags = site_plugin_flags(site_plugins)
    site = site_name if site_name is not None else url_host(F.col("url"))
    base = (posts.select("id", "site_id", "post_title", "url").join(flags, "site_id", "left")
            .join(wide, F.col("id") == F.col("post_id"), "left"))
    fallback = F.concat(F.col("post_title"), F.lit(" - "), site)
    y, r, a = (F.coalesce(F.col(f"has_{p}"), F.lit(False)) for p in ("yoast", "rankmath", "aioseo"))

    def pick(default: Column, *steps) -> Column:
        out = default
        for cond, val in steps:
            out = F.when(cond, val).otherwise(out)
        return out

    def templ(raw: Column, marker: str) -> Column:
        return F.when(_empty(raw) | F.contains(raw, F.lit(marker)), fallback).otherwise(raw)

    yt, rt, at = _meta("_yoast_wpseo_title"), _meta("rank_math_title"), _meta("_aioseo_title")
    title = pick(F.lit(""), (y, templ(yt, "%%")), (r, templ(rt, "%")), (a, templ(at, "#")))
    title = F.when(_empty(title), fallback).otherwise(title)
    return base.select(
        F.col("id").cast("bigint").alias("id"),
        title.alias("title"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_metadesc")), (r, _meta("rank_math_description")),
             (a, _meta("_aioseo_description"))).alias("description"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_focuskw")), (r, _meta("rank_math_focus_keyword"))).alias("focus_keyword"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_canonical")), (r, _meta("rank_math_canonical_url")),
             (a, _meta("_aioseo_canonical_url"))).alias("canonical"),
        pick(F.lit(DEFAULT_ROBOTS), (r, _meta("rank_math_robots"))).alias("robots"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_opengraph-title"))).alias("og_title"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_opengraph-description"))).alias("og_description"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_opengraph-image"))).alias("og_image"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_twitter-title"))).alias("twitter_title"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_twitter-description"))).alias("twitter_description"),
        pick(F.lit(""), (y, _meta("_yoast_wpseo_twitter-image"))).alias("twitter_image"),
    )


def featured_images(postmeta: DataFrame, attachments: DataFrame) -> DataFrame:
    """post_id -> featured image url via ``_thumbnail_id`` -> attachment."""
    thumb = (load_postmeta(postmeta, [THUMBNAIL_KEY])
             .select("post_id", F.col("meta_value").try_cast("bigint").alias("thumb_id")))
    return (thumb.join(attachments.select(F.col("id").alias("thumb_id"), "source_url"), "thumb_id")
            .select("post_id", F.col("source_url").alias("featured_image")))


def seo_fallbacks(seo: DataFrame, posts: DataFrame, excerpts: DataFrame, featured: DataFrame) -> DataFrame:
    """The export's seo record: PHP ``?:`` fallbacks to title, excerpt, url, image."""
    from pagelens.functions.common import elvis
    j = (seo.join(posts.select(F.col("id").cast("bigint").alias("id"), "post_title", "url"), "id")
         .join(excerpts, "id", "left")
         .join(featured.select(F.col("post_id").cast("bigint").alias("id"), "featured_image"), "id", "left"))
    return j.select(
        "id",
        elvis("title", "post_title").alias("meta_title"),
        elvis("description", "excerpt").alias("meta_description"),
        "focus_keyword",
        elvis("canonical", "url").alias("canonical_url"),
        "robots", "og_title", "og_description",
        elvis("og_image", "featured_image").alias("og_image"),
        "twitter_title", "twitter_description",
        elvis("twitter_image", "featured_image").alias("twitter_image"),
    )


def seo_meta_read(posts: DataFrame, postmeta: DataFrame, site_plugins: DataFrame) -> DataFrame:
    """``get_all_meta`` for every post as (id, field, value) rows.

    Non-empty values of the active plugin's keys and the generic backup keys,
    plus ``seo_plugin`` and ``echo5_managed`` rows.
    """
    spark = posts.sparkSession
    active = active_seo_plugin(posts, site_plugins)
    kmap = F.broadcast(key_map_df(spark))
    backup = F.broadcast(spark.createDataFrame(list(BACKUP_FIELDS), "meta_key string, field string"))
    all_keys = sorted({k for pairs in META_KEYS.values() for _, k in pairs} | {k for k, _ in BACKUP_FIELDS}
                      | {MANAGED_KEY})
    pm = load_postmeta(postmeta, all_keys).withColumnRenamed("post_id", "id")
    nonempty = ~falsy(F.col("meta_value"))
    by_plugin = (pm.join(active, "id")
                 .join(kmap, (kmap.meta_key == pm.meta_key) & (kmap.plugin == F.col("seo_plugin")))
                 .filter(nonempty).select("id", "field", F.col("meta_value").alias("value")))
    generic = (pm.join(backup, "meta_key").filter(nonempty)
               .select("id", "field", F.col("meta_value").alias("value")))
    managed = (active.join(pm.filter(F.col("meta_key") == MANAGED_KEY), "id", "left")
               .select("id", F.lit("echo5_managed").alias("field"),
                       F.when(falsy(F.col("meta_value")), F.lit("false")).otherwise(F.lit("true")).alias("value")))
    plugin = active.select("id", F.lit("seo_plugin").alias("field"), F.col("seo_plugin").alias("value"))
    return by_plugin.unionByName(generic).unionByName(managed).unionByName(plugin)


# Plugin info reported by the export (name -> plugin column).
INFO_PLUGINS = ("yoast", "rankmath", "aioseo")


def seo_plugin_info(site_plugins: DataFrame) -> DataFrame:
    """Per site: active plugin -> version for yoast/rankmath/aioseo (inactive dropped)."""
    return (site_plugins.filter(F.col("plugin").isin(*INFO_PLUGINS) & ~falsy(F.col("version")))
            .groupBy("site_id", "plugin").agg(F.max("version").alias("version")))


# Path fragments that mark each addon family as active.
CAPABILITY_FRAGMENTS = {
    "elementor": ("elementor/elementor.php",),
    "royal_elements": ("royal-elementor-addons", "wpr-addons"),
    "pro_elements": ("pro-elements", "proelements"),
    "elementor_pro": ("elementor-pro/elementor-pro.php",),
}


def plugin_capabilities(site_plugins: DataFrame) -> DataFrame:
    """Per site: addon-family flags by plugin-path substring, and pro_capable."""
    aggs = []
    for fam, frags in CAPABILITY_FRAGMENTS.items():
        hit = F.lit(False)
        for fr in frags:
            hit = hit | F.contains(F.col("path"), F.lit(fr))
        aggs.append(F.bool_or(hit).alias(fam))
    caps = distinct_plugins(site_plugins).groupBy("site_id").agg(*aggs)
    return caps.withColumn("pro_capable", F.col("elementor_pro") | F.col("pro_elements"))


def distinct_plugins(site_plugins: DataFrame, network_plugins: DataFrame | None = None) -> DataFrame:
    """Active plugin paths per site: the site's own list plus its network's list, distinct.

    ``network_plugins`` (network_id, path) meets the distinct sites on the network's
    id; sites without a ``network_id`` belong to network 0.
    """
    paths = site_plugins.select("site_id", "path")
    if network_plugins is not None:
        network = F.col("network_id") if "network_id" in site_plugins.columns else F.lit(0).cast("bigint")
        sites = site_plugins.select("site_id", network.alias("network_id")).distinct()
        net = network_plugins.select(F.col("network_id").cast("bigint").alias("network_id"), "path").distinct()
        paths = paths.unionByName(sites.join(net, "network_id").select("site_id", "path"))
    return paths.distinct()


def schema_merge(schemas, structured) -> Column:
    """Merge stored schema map with structured data (JSON text).

    Structured data with ``@graph``/``@type`` is stored under
    ``structured_data``; otherwise its keys are merged in (later wins, via the
    session's LAST_WIN map-key policy). Empty entries are dropped.
    """
    s = F.coalesce(F.col(schemas) if isinstance(schemas, str) else schemas,
                   F.create_map().cast("map<string,string>"))
    sd_text = F.col(structured) if isinstance(structured, str) else structured
    sd = F.from_json(sd_text, "map<string,string>")
    wrapped = F.when(sd.isNotNull() & (F.map_contains_key(sd, "@graph") | F.map_contains_key(sd, "@type")),
                     F.create_map(F.lit("structured_data"), sd_text))
    extra = F.coalesce(wrapped, sd, F.create_map().cast("map<string,string>"))
    merged = F.map_concat(s, F.when(falsy(sd_text), F.create_map().cast("map<string,string>")).otherwise(extra))
    return F.map_filter(merged, lambda k, v: ~(falsy(v) | v.isin("null", "{}", "[]", "false")))
