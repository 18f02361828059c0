"""M5 queries: postmeta, SEO resolution, fallbacks, meta read, plugins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.functions import text as T
from pagelens.operators import seo as S
from pagelens.plans.duck import elvis_sql, falsy_sql, host_sql, strip_sql
from pagelens.plans.registry import query


@query("load_postmeta", oracle="""
SELECT post_id, meta_key, arg_min(meta_value, meta_id) AS meta_value FROM postmeta GROUP BY post_id, meta_key
""", views=("postmeta",))
def load_postmeta(t):
    """First value per (post, key) by meta_id (get_post_meta single)."""
    return S.load_postmeta(t.postmeta)


FLAGS_SQL = """f AS (SELECT site_id,
  coalesce(bool_or(plugin = 'yoast'), false) AS y, coalesce(bool_or(plugin = 'rankmath'), false) AS r,
  coalesce(bool_or(plugin = 'aioseo'), false) AS a, coalesce(bool_or(plugin = 'seopress'), false) AS sp,
  coalesce(bool_or(plugin = 'tsf'), false) AS tsf
  FROM site_plugins GROUP BY site_id),
ap AS (SELECT CAST(p.id AS BIGINT) AS id, p.site_id,
  CASE WHEN f.y THEN 'yoast' WHEN f.r THEN 'rankmath' WHEN f.a THEN 'aioseo' WHEN f.sp THEN 'seopress'
       WHEN f.tsf THEN 'tsf' ELSE 'generic' END AS seo_plugin
  FROM posts p LEFT JOIN f ON p.site_id = f.site_id)"""


@query("active_seo_plugin", oracle=f"WITH {FLAGS_SQL} SELECT id, site_id, seo_plugin FROM ap",
       views=("posts", "site_plugins"))
def active_seo_plugin(t):
    """SEO plugin in effect for every post (site's first active, else generic)."""
    return S.active_seo_plugin(t.posts, t.site_plugins)


def _wide_sql(keys) -> str:
    cols = ",\n  ".join(f"arg_min(meta_value, meta_id) FILTER (WHERE meta_key = '{k}') AS \"{k}\"" for k in keys)
    return f"w AS (SELECT post_id,\n  {cols}\n FROM postmeta GROUP BY post_id)"


def _m(k: str) -> str:
    return f"coalesce(\"{k}\", '')"


RESOLVE_SQL = f"""{FLAGS_SQL},
{_wide_sql(S.RESOLVE_KEYS)},
b AS (SELECT p.id, p.post_title, p.url, coalesce(f.y, false) AS y, coalesce(f.r, false) AS r,
        coalesce(f.a, false) AS a, w.*, p.post_title || ' - ' || {host_sql('p.url')} AS fb
      FROM posts p LEFT JOIN f ON p.site_id = f.site_id LEFT JOIN w ON w.post_id = p.id),
t1 AS (SELECT *,
  CASE WHEN a THEN CASE WHEN {falsy_sql(_m('_aioseo_title'))} OR contains({_m('_aioseo_title')}, '#') THEN fb ELSE {_m('_aioseo_title')} END
       WHEN r THEN CASE WHEN {falsy_sql(_m('rank_math_title'))} OR contains({_m('rank_math_title')}, '%') THEN fb ELSE {_m('rank_math_title')} END
       WHEN y THEN CASE WHEN {falsy_sql(_m('_yoast_wpseo_title'))} OR contains({_m('_yoast_wpseo_title')}, '%%') THEN fb ELSE {_m('_yoast_wpseo_title')} END
       ELSE '' END AS t0
  FROM b),
seo AS (SELECT CAST(id AS BIGINT) AS id,
  CASE WHEN {falsy_sql('t0')} THEN fb ELSE t0 END AS title,
  CASE WHEN a THEN {_m('_aioseo_description')} WHEN r THEN {_m('rank_math_description')}
       WHEN y THEN {_m('_yoast_wpseo_metadesc')} ELSE '' END AS description,
  CASE WHEN r THEN {_m('rank_math_focus_keyword')} WHEN y THEN {_m('_yoast_wpseo_focuskw')} ELSE '' END AS focus_keyword,
  CASE WHEN a THEN {_m('_aioseo_canonical_url')} WHEN r THEN {_m('rank_math_canonical_url')}
       WHEN y THEN {_m('_yoast_wpseo_canonical')} ELSE '' END AS canonical,
  CASE WHEN r THEN {_m('rank_math_robots')} ELSE 'index, follow' END AS robots,
  CASE WHEN y THEN {_m('_yoast_wpseo_opengraph-title')} ELSE '' END AS og_title,
  CASE WHEN y THEN {_m('_yoast_wpseo_opengraph-description')} ELSE '' END AS og_description,
  CASE WHEN y THEN {_m('_yoast_wpseo_opengraph-image')} ELSE '' END AS og_image,
  CASE WHEN y THEN {_m('_yoast_wpseo_twitter-title')} ELSE '' END AS twitter_title,
  CASE WHEN y THEN {_m('_yoast_wpseo_twitter-description')} ELSE '' END AS twitter_description,
  CASE WHEN y THEN {_m('_yoast_wpseo_twitter-image')} ELSE '' END AS twitter_image
  FROM t1)"""


@query("seo_resolve", oracle=f"WITH {RESOLVE_SQL} SELECT * FROM seo", views=("posts", "site_plugins", "postmeta"))
def seo_resolve(t):
    """Resolved SEO fields of every post across Yoast -> RankMath -> AIOSEO."""
    return S.seo_resolve(t.posts, t.postmeta, t.site_plugins)


FALLBACK_SQL = f"""{RESOLVE_SQL},
ex AS (SELECT CAST(id AS BIGINT) AS id, post_excerpt,
    list_filter(string_split_regex({strip_sql('post_content')}, '[\\n\\r\\t ]+'), lambda x: x <> '') AS ws FROM posts),
exc AS (SELECT id, CASE WHEN post_excerpt IS NOT NULL AND post_excerpt <> '' THEN post_excerpt
       ELSE array_to_string(list_slice(ws, 1, 30), ' ') || CASE WHEN len(ws) > 30 THEN '&hellip;' ELSE '' END
       END AS excerpt FROM ex),
th AS (SELECT post_id, TRY_CAST(arg_min(meta_value, meta_id) AS BIGINT) AS thumb_id FROM postmeta
       WHERE meta_key = '_thumbnail_id' GROUP BY post_id),
fi AS (SELECT CAST(th.post_id AS BIGINT) AS id, a.source_url AS featured_image FROM th JOIN attachments a ON a.id = th.thumb_id)"""


@query("seo_fallbacks", oracle=f"""WITH {FALLBACK_SQL}
SELECT s.id, {elvis_sql('s.title', 'p.post_title')} AS meta_title,
  {elvis_sql('s.description', 'exc.excerpt')} AS meta_description, s.focus_keyword,
  {elvis_sql('s.canonical', 'p.url')} AS canonical_url, s.robots, s.og_title, s.og_description,
  {elvis_sql('s.og_image', 'fi.featured_image')} AS og_image, s.twitter_title, s.twitter_description,
  {elvis_sql('s.twitter_image', 'fi.featured_image')} AS twitter_image
FROM seo s JOIN posts p ON s.id = p.id LEFT JOIN exc ON exc.id = s.id LEFT JOIN fi ON fi.id = s.id
""", views=("posts", "site_plugins", "postmeta", "attachments"))
def seo_fallbacks(t):
    """Export seo record: falsy fields fall back to title, excerpt, url, featured image."""
    posts = t.posts
    seo = S.seo_resolve(posts, t.postmeta, t.site_plugins)
    exc = posts.select(F.col("id").cast("bigint").alias("id"),
                       T.excerpt(F.col("post_excerpt"), F.col("post_content")).alias("excerpt"))
    feat = S.featured_images(t.postmeta, t.attachments)
    return S.seo_fallbacks(seo, posts, exc, feat)


@query("featured_image_join", oracle="""
WITH th AS (SELECT post_id, TRY_CAST(arg_min(meta_value, meta_id) AS BIGINT) AS thumb_id FROM postmeta
            WHERE meta_key = '_thumbnail_id' GROUP BY post_id)
SELECT th.post_id, a.source_url AS featured_image FROM th JOIN attachments a ON a.id = th.thumb_id
""", views=("postmeta", "attachments"))
def featured_image_join(t):
    """post -> featured image url through _thumbnail_id and the attachment table."""
    return S.featured_images(t.postmeta, t.attachments)


def _keymap_sql() -> str:
    rows = ", ".join(f"('{p}', '{f}', '{k}')" for p, pairs in S.META_KEYS.items() for f, k in pairs)
    e5 = ", ".join(f"('{k}', '{f}')" for k, f in S.BACKUP_FIELDS)
    return (f"km AS (SELECT * FROM (VALUES {rows}) v(plugin, field, meta_key)),\n"
            f"e5 AS (SELECT * FROM (VALUES {e5}) v(meta_key, field))")


@query("seo_meta_read", oracle=f"""WITH {FLAGS_SQL}, {_keymap_sql()},
pm AS (SELECT CAST(post_id AS BIGINT) AS id, meta_key, arg_min(meta_value, meta_id) AS meta_value
       FROM postmeta GROUP BY post_id, meta_key)
SELECT pm.id, km.field, pm.meta_value AS value FROM pm JOIN ap ON ap.id = pm.id
  JOIN km ON km.meta_key = pm.meta_key AND km.plugin = ap.seo_plugin WHERE NOT {falsy_sql('pm.meta_value')}
UNION ALL
SELECT pm.id, e5.field, pm.meta_value FROM pm JOIN e5 ON e5.meta_key = pm.meta_key WHERE NOT {falsy_sql('pm.meta_value')}
UNION ALL
SELECT ap.id, 'echo5_managed', CASE WHEN {falsy_sql('pm.meta_value')} THEN 'false' ELSE 'true' END
FROM ap LEFT JOIN pm ON pm.id = ap.id AND pm.meta_key = '_echo5_seo_managed'
UNION ALL
SELECT id, 'seo_plugin', seo_plugin FROM ap
""", views=("posts", "site_plugins", "postmeta"))
def seo_meta_read(t):
    """get_all_meta rows for every post: active plugin's non-empty fields + generic + flags."""
    return S.seo_meta_read(t.posts, t.postmeta, t.site_plugins)


@query("seo_plugin_info", oracle="""
WITH i AS (SELECT site_id, plugin, max(version) AS version FROM site_plugins
           WHERE plugin IN ('yoast', 'rankmath', 'aioseo') AND version IS NOT NULL AND version NOT IN ('', '0')
           GROUP BY site_id, plugin)
SELECT CAST(p.id AS BIGINT) AS id, i.plugin, i.version FROM posts p JOIN i ON i.site_id = p.site_id
WHERE p.post_status = 'publish'
""", views=("posts", "site_plugins"))
def seo_plugin_info(t):
    """Active SEO plugins with versions, reported for every published post's site."""
    info = S.seo_plugin_info(t.site_plugins)
    posts = t.posts.filter(F.col("post_status") == "publish")
    return (posts.join(info, "site_id").select(F.col("id").cast("bigint").alias("id"), "plugin", "version"))


CAPS_SQL = """caps AS (SELECT site_id,
  bool_or(contains(path, 'elementor/elementor.php')) AS elementor,
  bool_or(contains(path, 'royal-elementor-addons') OR contains(path, 'wpr-addons')) AS royal_elements,
  bool_or(contains(path, 'pro-elements') OR contains(path, 'proelements')) AS pro_elements,
  bool_or(contains(path, 'elementor-pro/elementor-pro.php')) AS elementor_pro
  FROM (SELECT DISTINCT site_id, path FROM site_plugins) GROUP BY site_id)"""


@query("plugin_capabilities", oracle=f"""WITH {CAPS_SQL}
SELECT CAST(p.page_id AS BIGINT) AS id, c.site_id, c.elementor, c.royal_elements, c.pro_elements, c.elementor_pro,
  c.elementor_pro OR c.pro_elements AS pro_capable
FROM builder_trees p JOIN caps c ON c.site_id = p.site_id
""", views=("site_plugins", "builder_trees"))
def plugin_capabilities(t):
    """Addon-family flags of each builder page's site (path-substring rules)."""
    caps = S.plugin_capabilities(t.site_plugins)
    return (t.builder_trees.select(F.col("page_id").cast("bigint").alias("id"), "site_id")
            .join(caps, "site_id").select("id", "site_id", "elementor", "royal_elements", "pro_elements",
                                          "elementor_pro", "pro_capable"))


@query("distinct_plugins", oracle="""
WITH d AS (SELECT DISTINCT site_id, path FROM (
  SELECT site_id, path FROM site_plugins
  UNION ALL SELECT s.site_id, n.path FROM (SELECT DISTINCT site_id FROM site_plugins) s,
    (SELECT DISTINCT path FROM site_plugins WHERE site_id = 0) n))
SELECT CAST(p.id AS BIGINT) AS id, d.path FROM posts p JOIN d ON d.site_id = p.site_id WHERE p.post_status = 'publish'
""", views=("posts", "site_plugins"))
def distinct_plugins(t):
    """Active plugin paths per published post's site: site list + network list (site 0's), distinct."""
    sp = t.site_plugins
    network = sp.filter(F.col("site_id") == 0).select(F.col("site_id").alias("network_id"), "path")
    paths = S.distinct_plugins(sp, network)
    return (t.posts.filter(F.col("post_status") == "publish").join(paths, "site_id")
            .select(F.col("id").cast("bigint").alias("id"), "path"))
