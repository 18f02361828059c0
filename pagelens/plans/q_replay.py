"""Publishing a batch: pages, meta values, versions and log as one committed set of tables; every request counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pagelens.operators import publish as P
from pagelens.operators import replay as R
from pagelens.operators import seo as S
from pagelens.operators import site as X
from pagelens.operators.rollbacks import rollback_batch
from pagelens.plans.duck import falsy_sql
from pagelens.plans.q_content import SEO_REQ, seo_requests
from pagelens.plans.q_publish import IN_TURN_SQL, PRETTY_SQL, SCHEMA_RE_SQL, WRAP_SQL
from pagelens.plans.q_seo import FLAGS_SQL
from pagelens.plans.registry import REGISTRY, query
from pagelens.session import checkpoint_dir
from pagelens.sources.sinks import commit_tables, committed

VIEWS = ("posts", "publish_requests", "postmeta", "site_plugins", "page_versions", "attachments", "users")


def _requests(t):
    """The batch with each request's post (by slug), its meta fields, and the attachment that its featured image is already."""
    r = t.publish_requests.withColumnRenamed("title", "_title").withColumns({"meta_title": F.col("_title"), "title": F.col("_title"), "secondary_keywords": F.from_json("secondary_json", "array<string>")}).drop("_title")
    r = X.find_by_slug(r, t.posts)
    media = t.attachments.groupBy("url_hash").agg(F.min("id").alias("thumbnail_id"))
    return r.join(media, F.md5("featured_url") == F.col("url_hash"), "left").drop("url_hash")


def _with_pages(requests, pages):
    """The requests with ``post_id`` being the id of the page that they end up in."""
    ids = pages.select("slug", R.page_id().alias("_page"))
    return requests.join(ids, "slug").withColumn("post_id", F.col("_page")).drop("_page")


def _pages(t, requests):
    return R.replayed_pages(requests, t.posts, R.newest(R.saves(requests), "slug", R.KEPT_VERSIONS))


def _ops(t, requests):
    active = S.active_seo_plugin(t.posts, t.site_plugins)
    seo, own = R.seo_ops(requests, active), R.publish_ops(requests)
    return seo.unionByName(own.withColumn("step", F.col("step") + 100))  # publishing writes after the SEO handler


# -- the same in SQL: request after request ---------------------------------------------------------

KEYS_SQL = """km(plugin, field, meta_key) AS (VALUES
  ('yoast', 'title', '_yoast_wpseo_title'), ('yoast', 'description', '_yoast_wpseo_metadesc'), ('yoast', 'focus', '_yoast_wpseo_focuskw'), ('yoast', 'canonical', '_yoast_wpseo_canonical'),
  ('yoast', 'og_title', '_yoast_wpseo_opengraph-title'), ('yoast', 'og_description', '_yoast_wpseo_opengraph-description'), ('yoast', 'og_image', '_yoast_wpseo_opengraph-image'),
  ('yoast', 'tw_title', '_yoast_wpseo_twitter-title'), ('yoast', 'tw_description', '_yoast_wpseo_twitter-description'),
  ('rankmath', 'title', 'rank_math_title'), ('rankmath', 'description', 'rank_math_description'), ('rankmath', 'focus', 'rank_math_focus_keyword'), ('rankmath', 'canonical', 'rank_math_canonical_url'),
  ('rankmath', 'og_title', 'rank_math_facebook_title'), ('rankmath', 'og_description', 'rank_math_facebook_description'), ('rankmath', 'og_image', 'rank_math_facebook_image'),
  ('rankmath', 'tw_title', 'rank_math_twitter_title'), ('rankmath', 'tw_description', 'rank_math_twitter_description'),
  ('aioseo', 'title', '_aioseo_title'), ('aioseo', 'description', '_aioseo_description'), ('aioseo', 'focus', '_aioseo_keywords'), ('aioseo', 'canonical', '_aioseo_canonical_url'),
  ('aioseo', 'og_title', '_aioseo_og_title'), ('aioseo', 'og_description', '_aioseo_og_description'), ('aioseo', 'og_image', '_aioseo_og_image_custom_url'),
  ('aioseo', 'tw_title', '_aioseo_twitter_title'), ('aioseo', 'tw_description', '_aioseo_twitter_description'),
  ('generic', 'title', '_echo5_seo_title'), ('generic', 'description', '_echo5_seo_description'), ('generic', 'focus', '_echo5_focus_keyword'), ('generic', 'canonical', '_echo5_canonical'),
  ('generic', 'og_title', '_echo5_og_title'), ('generic', 'og_description', '_echo5_og_description'), ('generic', 'og_image', '_echo5_og_image'))"""
SNAPSHOT_SQL = """('rank_math_title', 'rank_math_description', 'rank_math_focus_keyword', 'rank_math_canonical_url', 'rank_math_facebook_title', 'rank_math_facebook_description',
  'rank_math_facebook_image', 'rank_math_twitter_title', 'rank_math_twitter_description', '_yoast_wpseo_title', '_yoast_wpseo_metadesc', '_yoast_wpseo_focuskw', '_yoast_wpseo_canonical',
  '_yoast_wpseo_opengraph-title', '_yoast_wpseo_opengraph-description', '_yoast_wpseo_opengraph-image', '_yoast_wpseo_twitter-title', '_yoast_wpseo_twitter-description',
  '_aioseo_title', '_aioseo_description', '_aioseo_keywords', '_seopress_titles_title', '_seopress_titles_desc', '_seopress_analysis_target_kw', '_genesis_title', '_genesis_description',
  'focus_keyword', '_echo5_seo_title', '_echo5_seo_description', '_echo5_focus_keyword', '_echo5_canonical')"""
_OG = f"(NOT {falsy_sql('og_title')} OR NOT {falsy_sql('og_description')})"
REPLAY_SQL = f"""{IN_TURN_SQL}, {FLAGS_SQL}, {KEYS_SQL},
ids AS (SELECT slug, CAST(coalesce(any_value(post_id), 1000000000000 + arg_min(request_id, rn)) AS BIGINT) AS page_id FROM rq GROUP BY slug),
rr AS (SELECT rq.*, ids.page_id, coalesce(ap.seo_plugin, 'generic') AS plugin, strftime(requested_at, '%Y-%m-%d %H:%M:%S') AS tm, m.thumbnail_id,
    coalesce(CAST(secondary_json AS VARCHAR[]), []) AS kws
  FROM rq JOIN ids USING (slug) LEFT JOIN ap ON ap.id = rq.post_id LEFT JOIN (SELECT url_hash, min(id) AS thumbnail_id FROM attachments GROUP BY url_hash) m ON m.url_hash = md5(featured_url)),
fl AS (SELECT page_id, slug, rn, plugin, field, step, v FROM (
  SELECT *, 'title' AS field, 1 AS step, title AS v FROM rr WHERE NOT {falsy_sql('title')} UNION ALL SELECT *, 'description', 2, meta_description FROM rr WHERE NOT {falsy_sql('meta_description')}
  UNION ALL SELECT *, 'focus', 3, focus_keyword FROM rr WHERE NOT {falsy_sql('focus_keyword')} UNION ALL SELECT *, 'canonical', 6, canonical FROM rr WHERE NOT {falsy_sql('canonical')}
  UNION ALL SELECT *, 'og_title', 7, og_title FROM rr WHERE NOT {falsy_sql('og_title')} UNION ALL SELECT *, 'og_description', 8, og_description FROM rr WHERE NOT {falsy_sql('og_description')}
  UNION ALL SELECT *, 'og_image', 9, og_image FROM rr WHERE {_OG} AND NOT {falsy_sql('og_image')}
  UNION ALL SELECT *, 'tw_title', 10, CASE WHEN NOT {falsy_sql('twitter_title')} THEN twitter_title ELSE og_title END FROM rr WHERE {_OG} AND NOT ({falsy_sql('twitter_title')} AND {falsy_sql('og_title')})
  UNION ALL SELECT *, 'tw_description', 11, CASE WHEN NOT {falsy_sql('twitter_description')} THEN twitter_description ELSE og_description END FROM rr
    WHERE {_OG} AND NOT ({falsy_sql('twitter_description')} AND {falsy_sql('og_description')}))),
seo_op AS (
  SELECT page_id, slug, rn, step, meta_key AS k, 'set' AS op, v FROM fl JOIN km ON km.plugin = fl.plugin AND km.field = fl.field
  UNION ALL SELECT page_id, slug, rn, step, CASE field WHEN 'title' THEN '_echo5_seo_title' WHEN 'description' THEN '_echo5_seo_description' WHEN 'focus' THEN '_echo5_focus_keyword' ELSE '_echo5_canonical' END, 'set', v
    FROM fl WHERE field IN ('title', 'description', 'focus', 'canonical')
  UNION ALL SELECT page_id, slug, rn, 2, 'post_excerpt', 'set', v FROM fl WHERE field = 'description'
  UNION ALL SELECT page_id, slug, rn, 4, 'rank_math_focus_keyword', 'append', array_to_string(kws, ',') FROM rr WHERE len(kws) > 0 AND plugin = 'rankmath'
  UNION ALL SELECT page_id, slug, rn, 5, '_echo5_secondary_keywords', 'set', CAST(to_json(kws) AS VARCHAR) FROM rr WHERE len(kws) > 0
  UNION ALL SELECT page_id, slug, rn, 12, unnest(['_echo5_seo_managed', '_echo5_seo_updated', '_echo5_seo_plugin_used']), 'set', unnest(['1', tm, plugin]) FROM rr),
pub_op AS (
  SELECT page_id, slug, rn, 20 AS step, unnest(['_echo5_managed', '_echo5_last_sync', '_echo5_update_mode']) AS k, 'set' AS op, unnest(['1', tm, update_mode]) AS v FROM rr
  UNION ALL SELECT page_id, slug, rn, 20, '_thumbnail_id', 'set', CAST(thumbnail_id AS VARCHAR) FROM rr WHERE thumbnail_id IS NOT NULL
  UNION ALL SELECT page_id, slug, rn, 20, unnest(['_echo5_structured_data', '_echo5_schemas']), 'set', schema_json FROM rr WHERE NOT {falsy_sql('schema_json')} AND schema_json NOT IN ('{{}}', '[]', 'null')
  UNION ALL SELECT page_id, slug, rn, 20, '_wp_page_template', 'set', template FROM rr WHERE NOT {falsy_sql('template')}
  UNION ALL SELECT page_id, slug, rn, 20, '_echo5_hide_title', 'set', '1' FROM rr WHERE hide_title
  UNION ALL SELECT page_id, slug, rn, 20, '_echo5_custom_css', 'set', custom_css FROM rr WHERE NOT {falsy_sql('custom_css')}),
ops AS (SELECT * FROM seo_op UNION ALL SELECT * FROM pub_op),
cur AS (SELECT post_id, meta_key, arg_min(meta_value, meta_id) AS v FROM postmeta GROUP BY post_id, meta_key),
sv AS (SELECT slug, CAST(floor(epoch(requested_at)) AS BIGINT) AS version, max(rn) AS cut, count(*) AS n FROM rq WHERE post_id IS NOT NULL OR rn > 1 GROUP BY 1, 2),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY version DESC) AS r FROM sv) WHERE r <= 9),
wr AS (SELECT slug, rn, {WRAP_SQL.replace('html', 'merged')} AS wrapped FROM ap_merged),
vs AS (SELECT kept.slug, ids.page_id, kept.version, kept.cut, CASE WHEN cut = 1 THEN p.post_content ELSE wr.wrapped END AS content, CASE WHEN cut = 1 THEN p.post_title ELSE b.title END AS post_title
  FROM kept JOIN ids USING (slug) LEFT JOIN posts p ON p.id = ids.page_id LEFT JOIN wr ON wr.slug = kept.slug AND wr.rn = kept.cut - 1 LEFT JOIN rq b ON b.slug = kept.slug AND b.rn = kept.cut - 1)""".replace(
    "ap(slug, rn, merged)", "ap_merged(slug, rn, merged)").replace("FROM ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn + 1", "FROM ap_merged ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn + 1").replace(
    "FROM ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn WHERE st.rn = st.n", "FROM ap_merged ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn WHERE st.rn = st.n")


def _value(ops: str, old: str) -> str:
    """Operations (a list of structs, in order) applied to a stored value in turn."""
    return (f"list_reduce(list_prepend({{'op': 'set', 'v': {old}}}, {ops}), lambda a, x: {{'op': 'set', 'v': CASE WHEN x.op = 'set' THEN x.v "
            f"WHEN a.v IS NULL OR a.v IN ('', '0') THEN x.v ELSE a.v || ',' || x.v END}}).v")


def _final_sql(ops: str) -> str:
    return f"""SELECT o.page_id AS post_id, o.k AS meta_key, {_value('l', 'cur.v')} AS meta_value
FROM (SELECT page_id, k, list({{'op': op, 'v': v}} ORDER BY rn, step) AS l FROM {ops} GROUP BY page_id, k) o LEFT JOIN cur ON cur.post_id = o.page_id AND cur.meta_key = o.k"""


@query("save_meta_map", oracle=f"{REPLAY_SQL} {_final_sql('seo_op')}", views=VIEWS)
def save_meta_map(t):
    """Meta values after save_all_meta of every request of the batch: plugin and backup keys, keywords, Open Graph, flags."""
    r = _requests(t)
    r = _with_pages(r, r.groupBy("slug").agg(F.any_value("post_id").alias("post_id"), F.min_by("request_id", F.struct("requested_at", "request_id")).alias("first_request")))
    return R.apply_ops(R.seo_ops(r, S.active_seo_plugin(t.posts, t.site_plugins)), t.postmeta)


SNAP_META_SQL = f"""sk AS (SELECT vs.slug, vs.version, vs.cut, x.k, any_value(cur.v) AS old, list({{'op': ops.op, 'v': ops.v}} ORDER BY ops.rn, ops.step) FILTER (ops.rn < vs.cut) AS l
  FROM vs JOIN (SELECT DISTINCT slug, k FROM ops UNION SELECT slug, meta_key FROM cur JOIN ids ON ids.page_id = cur.post_id) x ON x.slug = vs.slug AND x.k IN {SNAPSHOT_SQL}
  LEFT JOIN cur ON cur.post_id = vs.page_id AND cur.meta_key = x.k LEFT JOIN ops ON ops.slug = vs.slug AND ops.k = x.k GROUP BY ALL),
sm AS (SELECT slug, version, string_agg(k || '=' || v, ';' ORDER BY k) AS seo_meta FROM (SELECT slug, version, k, {_value('coalesce(l, [])', 'old')} AS v FROM sk) WHERE v <> '' GROUP BY ALL)"""


@query("snapshot_versions", oracle=f"""{REPLAY_SQL}, {SNAP_META_SQL},
al AS (SELECT page_id, version, max(n) AS n, bool_or(n IS NULL) AS stored FROM (
    SELECT ids.page_id, sv.version, sv.n FROM sv JOIN ids USING (slug) UNION ALL SELECT page_id, version, NULL FROM page_versions WHERE page_id IN (SELECT page_id FROM sv JOIN ids USING (slug)))
  GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY version DESC) <= 9 AS top, sum(n) OVER (PARTITION BY page_id) + count(*) FILTER (stored) OVER (PARTITION BY page_id) AS total FROM al)
SELECT rk.page_id, rk.version, CASE WHEN n IS NOT NULL AND top THEN 'saved' WHEN top THEN 'kept' WHEN stored THEN 'deleted' ELSE 'dropped' END AS action,
  CASE WHEN n IS NOT NULL AND top THEN md5(vs.content) END AS content_md5, CASE WHEN n IS NOT NULL AND top THEN vs.post_title END AS post_title,
  CASE WHEN n IS NOT NULL AND top THEN coalesce(seo_meta, '') END AS seo_meta, CAST(total AS VARCHAR) AS version_count
FROM rk LEFT JOIN vs ON vs.page_id = rk.page_id AND vs.version = rk.version LEFT JOIN sm ON sm.slug = vs.slug AND sm.version = vs.version""", views=VIEWS)
def snapshot_versions(t):
    """Versions that the batch saves, keeps and deletes of every page, with text, title and meta as before the save, and the count."""
    r = _requests(t)
    seconds = R.saves(r)
    cuts = R.newest(seconds, "slug", R.KEPT_VERSIONS)
    pages = R.replayed_pages(r, t.posts, cuts)
    ledger, counts = R.version_ledger(seconds, pages, t.page_versions)
    ids = pages.select("slug", R.page_id().alias("post_id"))
    meta = R.meta_states(_ops(t, _with_pages(r, pages)), cuts, r, t.postmeta, ids)
    texts = R.saved_versions(pages, cuts).join(meta, ["slug", "version"], "left").drop("slug")
    told = F.array_join(F.transform(F.map_entries("seo_meta"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    out = ledger.join(texts, ["page_id", "version"], "left").join(counts.select("page_id", F.col("meta_value").alias("version_count")), "page_id")
    saved = lambda c: F.when(F.col("action") == "saved", c)
    return out.select("page_id", "version", "action", saved(F.md5("content")).alias("content_md5"), saved(F.col("post_title")).alias("post_title"), saved(F.coalesce(told, F.lit(""))).alias("seo_meta"), "version_count")


CONTENT_SQL = f"""w AS (SELECT mg.*, ids.page_id, {WRAP_SQL.replace('html', 'merged')} AS wrapped FROM mg JOIN ids USING (slug)),
sc AS (SELECT w.request_id, string_agg('<script type="application/ld+json">' || chr(10) || {PRETTY_SQL} || chr(10) || '</script>' || chr(10), '' ORDER BY je.key) AS scripts
  FROM w, json_each(w.schema_json) je WHERE je.value IS NOT NULL AND CAST(je.value AS VARCHAR) NOT IN ('', '0', 'null', '{{}}', '[]', 'false') GROUP BY w.request_id),
bl AS (SELECT w.*, chr(10) || '<!-- ECHO5:START SCHEMA -->' || chr(10) || coalesce(sc.scripts, '') || '<!-- ECHO5:END SCHEMA -->' || chr(10) AS block FROM w LEFT JOIN sc ON sc.request_id = w.request_id),
ct AS (SELECT *, CASE WHEN schema_json IS NULL OR len(json_keys(schema_json)) = 0 THEN wrapped WHEN regexp_matches(wrapped, {SCHEMA_RE_SQL}) THEN regexp_replace(wrapped, {SCHEMA_RE_SQL}, block, 'g')
  ELSE wrapped || block END AS content FROM bl)"""


def _posts(t, pages):
    """Post rows after the batch, in the columns of ``posts`` that publishing writes."""
    content = P.inject_schema(P.wrap_content(F.element_at("states", -1)["html"]), F.from_json("schema_json", "map<string,string>"))
    parents = X.parent_lookup(pages.select("request_id", "parent_slug"), t.posts).select("request_id", "post_parent")
    author = X.publisher_author(t.users).scalar()  # one value
    return pages.join(parents, "request_id", "left").select(
        R.page_id().cast("bigint").alias("id"), F.when(F.col("post_id").isNull(), "created").otherwise("updated").alias("action"), F.col("title").alias("post_title"),
        F.col("slug").alias("post_name"), content.alias("post_content"), F.col("status").alias("post_status"), F.coalesce("post_parent", F.lit(0)).cast("bigint").alias("post_parent"), author.cast("bigint").alias("post_author"))


@query("upsert_pages", oracle=f"""{REPLAY_SQL}, {CONTENT_SQL}
SELECT CAST(coalesce(ct.page_id, p.id) AS BIGINT) AS id, coalesce(ct.title, p.post_title) AS post_title, coalesce(ct.slug, p.post_name) AS post_name,
  coalesce(ct.status, p.post_status) AS post_status, md5(coalesce(ct.content, p.post_content)) AS content_md5
FROM posts p FULL OUTER JOIN ct ON ct.page_id = p.id""", views=VIEWS)
def upsert_pages(t):
    """Posts after the batch: pages of matched slugs updated by all their requests, new slugs inserted."""
    updates = _posts(t, _pages(t, _requests(t))).select("id", "post_title", "post_name", "post_content", "post_status")
    out = P.upsert_pages(t.posts.select("id", "post_title", "post_name", "post_content", "post_status"), updates)
    return out.select(F.col("id").cast("bigint").alias("id"), "post_title", "post_name", "post_status", F.md5("post_content").alias("content_md5"))


@query("upsert_meta", oracle=f"""{REPLAY_SQL}, ch AS ({_final_sql('ops')})
SELECT CAST(coalesce(ch.post_id, cur.post_id) AS BIGINT) AS post_id, coalesce(ch.meta_key, cur.meta_key) AS meta_key,
  CASE WHEN ch.meta_key IS NOT NULL THEN ch.meta_value ELSE cur.v END AS meta_value
FROM cur FULL OUTER JOIN ch ON ch.post_id = cur.post_id AND ch.meta_key = cur.meta_key""", views=VIEWS)
def upsert_meta(t):
    """Post meta after everything that the batch's requests set and append."""
    r = _requests(t)
    pages = r.groupBy("slug").agg(F.any_value("post_id").alias("post_id"), F.min_by("request_id", F.struct("requested_at", "request_id")).alias("first_request"))
    out = P.upsert_meta(t.postmeta, R.apply_ops(_ops(t, _with_pages(r, pages)), t.postmeta))
    return out.withColumn("post_id", F.col("post_id").cast("bigint"))


def publish_tables(t, folder: str) -> dict:
    """posts, meta, versions and log of the batch; the replayed pages are written to the folder once and read by all four."""
    r = _requests(t)
    seconds = R.saves(r)
    cuts = R.newest(seconds, "slug", R.KEPT_VERSIONS)
    R.replayed_pages(r, t.posts, cuts).write.parquet(f"{folder}/_pages")
    pages = t.spark.read.parquet(f"{folder}/_pages")
    ids = pages.select("slug", R.page_id().alias("post_id"))
    placed = _with_pages(r, pages)
    ops = _ops(t, placed)
    ledger, counts = R.version_ledger(seconds, pages, t.page_versions)
    saved = R.saved_versions(pages, cuts).join(R.meta_states(ops, cuts, r, t.postmeta, ids), ["slug", "version"], "left").drop("slug")
    versions = ledger.join(saved, ["page_id", "version"], "left")
    meta = R.apply_ops(ops, t.postmeta).select(F.col("post_id").alias("page_id"), "meta_key", "meta_value").unionByName(counts)
    first = pages.select("slug", F.when(F.col("post_id").isNull(), F.col("first_request")).alias("_made_by"))
    log = placed.join(first, "slug").select("request_id", F.col("post_id").alias("page_id"), "slug", F.lit("publish_success").alias("action"),
                                            F.when(F.col("request_id").eqNullSafe(F.col("_made_by")), "created").otherwise("updated").alias("result"), F.col("requested_at").alias("created_at"))
    return {"posts": _posts(t, pages), "meta": meta, "versions": versions, "log": log}


@query("publish_batch", oracle=f"""{REPLAY_SQL}, {CONTENT_SQL}, {SNAP_META_SQL},
par AS (SELECT r.request_id, CAST(coalesce(best.post_id, 0) AS BIGINT) AS post_parent FROM mg r LEFT JOIN best ON best.s = r.parent_slug),
au AS (SELECT CAST(coalesce(min(id) FILTER (WHERE lower(login) = 'echo5-seo'), arg_min(id, login) FILTER (WHERE lower(display_name) = 'echo5-seo'), 1) AS BIGINT) AS author_id FROM users),
ct2 AS (SELECT ct.*, par.post_parent FROM ct JOIN par USING (request_id)),
st9 AS (SELECT page_id, version, row_number() OVER (PARTITION BY page_id ORDER BY version DESC) <= 9 AS top, max(n) AS n FROM (
    SELECT ids.page_id, sv.version, sv.n FROM sv JOIN ids USING (slug) UNION ALL SELECT page_id, version, NULL FROM page_versions WHERE page_id IN (SELECT page_id FROM sv JOIN ids USING (slug))) GROUP BY page_id, version),
fin AS ({_final_sql('ops')})
SELECT 'posts' AS tbl, page_id, slug AS item, concat_ws('|', CASE WHEN post_id IS NULL THEN 'created' ELSE 'updated' END, title, status, CAST(post_parent AS VARCHAR), CAST((SELECT author_id FROM au) AS VARCHAR), md5(content)) AS value FROM ct2
UNION ALL SELECT 'meta', post_id, meta_key, meta_value FROM fin
UNION ALL SELECT 'meta', page_id, '_echo5_version_count', CAST(sum(n) + (SELECT count(*) FROM page_versions v WHERE v.page_id = x.page_id) AS VARCHAR) FROM (SELECT ids.page_id, sv.n FROM sv JOIN ids USING (slug)) x GROUP BY page_id
UNION ALL SELECT 'versions', s.page_id, CAST(s.version AS VARCHAR), CASE WHEN n IS NOT NULL AND top THEN concat_ws('|', 'saved', md5(vs.content), vs.post_title, coalesce(sm.seo_meta, ''))
    WHEN top THEN 'kept' WHEN EXISTS (SELECT 1 FROM page_versions v WHERE v.page_id = s.page_id AND v.version = s.version) THEN 'deleted' ELSE 'dropped' END
  FROM st9 s LEFT JOIN vs ON vs.page_id = s.page_id AND vs.version = s.version LEFT JOIN sm ON sm.slug = vs.slug AND sm.version = vs.version
UNION ALL SELECT 'log', page_id, CAST(request_id AS VARCHAR), concat_ws('|', 'publish_success', slug, CASE WHEN post_id IS NULL AND rn = 1 THEN 'created' ELSE 'updated' END, tm) FROM rr""", views=VIEWS)
def publish_batch(t):
    """The publish flow over a batch as one commit of four tables (posts, meta, versions, log), read back from the commit."""
    root = f"{checkpoint_dir(t.spark)}/publish-{uuid.uuid4().hex}"
    commit_tables(t.spark, root, "batch-1", lambda folder: publish_tables(t, folder))
    got = lambda name: committed(t.spark, root, name)
    told = F.array_join(F.transform(F.array_sort(F.map_entries("seo_meta")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    one = lambda df, tbl, page, item, value: df.select(F.lit(tbl).alias("tbl"), F.col(page).cast("bigint").alias("page_id"), F.col(item).cast("string").alias("item"), value.alias("value"))
    return one(got("posts"), "posts", "id", "post_name", F.concat_ws("|", "action", "post_title", "post_status", "post_parent", "post_author", F.md5("post_content"))).unionByName(
        one(got("meta"), "meta", "page_id", "meta_key", F.col("meta_value"))).unionByName(
        one(got("versions"), "versions", "page_id", "version", F.when(F.col("action") == "saved", F.concat_ws("|", "action", F.md5("content"), "post_title", F.coalesce(told, F.lit("")))).otherwise(F.col("action")))).unionByName(
        one(got("log"), "log", "page_id", "request_id", F.concat_ws("|", "action", "slug", "result", R.stamp(F.col("created_at")))))


# -- rollbacks -----------------------------------------------------------------------------------------

#: Rollbacks to stored versions, to ones that are not there, and to versions that earlier rollbacks of the batch have saved.
ASKED_SQL = """SELECT event_id AS request_id, event_id % 141 AS page_id,
  CASE event_id % 4 WHEN 0 THEN 1700000000 + event_id % 7 WHEN 1 THEN 1700000001 + event_id % 3 WHEN 2 THEN 5 ELSE {second} - 60 * 141 * (1 + event_id % 2) END AS version,
  {time} AS requested_at
FROM events"""


def _asked(t):
    time = "TIMESTAMP '2024-04-01 00:00:00' + INTERVAL '1' MINUTE * event_id"
    sql = ASKED_SQL.replace("{time}", time).replace("{second}", f"unix_timestamp(CAST({time} AS TIMESTAMP))").replace("FROM events", "FROM {events}")
    return t.spark.sql(sql, events=t.events).withColumn("version", F.col("version").cast("bigint"))


def _stored(t):
    whole = F.to_json(F.struct("content", F.coalesce(F.from_json("seo_meta_json", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("seo_meta"), "post_title"))
    return t.page_versions.select("page_id", "version", F.when(F.col("legacy_format"), F.col("content")).otherwise(whole).alias("meta_value"))


_RQ_TIME = "TIMESTAMP '2024-04-01 00:00:00' + INTERVAL '1' MINUTE * event_id"
ROLLBACK_SQL = f"""WITH RECURSIVE asked AS ({ASKED_SQL.replace('{time}', _RQ_TIME).replace('{second}', f'CAST(epoch({_RQ_TIME}) AS BIGINT)')}),
old AS (SELECT post_id AS page_id, meta_key, arg_min(meta_value, meta_id) AS meta_value FROM postmeta WHERE meta_key IN {SNAPSHOT_SQL} GROUP BY ALL HAVING arg_min(meta_value, meta_id) <> ''),
rq AS (SELECT a.*, CAST(epoch(requested_at) AS BIGINT) AS sec, row_number() OVER (PARTITION BY a.page_id ORDER BY requested_at, request_id) AS rn,
    p.id IS NOT NULL AS found, EXISTS (SELECT 1 FROM old WHERE old.page_id = a.page_id) AS om
  FROM asked a LEFT JOIN (SELECT id FROM posts WHERE post_type IN ('page', 'post')) p ON p.id = a.page_id),
sv AS (SELECT page_id, list({{'v': version, 'c': CAST(version AS VARCHAR), 't': CASE WHEN NOT legacy_format THEN CAST(version AS VARCHAR) END,
    'm': CASE WHEN NOT legacy_format AND seo_meta_json IS NOT NULL THEN [CAST(version AS VARCHAR)] ELSE []::VARCHAR[] END}}) AS vs FROM page_versions WHERE NOT {falsy_sql('content')} OR NOT legacy_format GROUP BY page_id),
f AS (
  SELECT s.page_id, 0::BIGINT AS rn, 'before' AS c, 'before' AS t, []::VARCHAR[] AS m, coalesce(sv.vs, []) AS vs, NULL::BIGINT AS request_id, NULL::BIGINT AS version, NULL::VARCHAR AS status, false AS restored, 0 AS saves, []::BIGINT[] AS mine
  FROM (SELECT DISTINCT page_id FROM asked) s LEFT JOIN sv ON sv.page_id = s.page_id
  UNION ALL
  SELECT page_id, rn, CASE WHEN ok THEN hit.c ELSE c END, CASE WHEN ok THEN coalesce(hit.t, t) ELSE t END,
    CASE WHEN ok THEN list_concat(list_filter(m, lambda x: NOT list_contains(hit.m, x)), hit.m) ELSE m END,
    CASE WHEN ok THEN list_filter(vs2, lambda x: len(list_filter(vs2, lambda y: y.v > x.v)) < 9) ELSE vs END,
    rid, ver, CASE WHEN NOT found THEN 'not_found' WHEN ok THEN 'rolled_back' ELSE 'version_not_found' END, ok AND len(hit.m) > 0, saves + CASE WHEN ok THEN 1 ELSE 0 END, CASE WHEN ok THEN list_append(mine, sec) ELSE mine END
  FROM (SELECT *, found AND hit IS NOT NULL AS ok, list_append(list_filter(vs, lambda x: x.v <> sec), {{'v': sec, 'c': c, 't': t, 'm': CASE WHEN om THEN list_prepend('before', m) ELSE m END}}) AS vs2
    FROM (SELECT f.page_id, rq.rn, f.c, f.t, f.m, f.vs, f.saves, f.mine, rq.request_id AS rid, rq.version AS ver, rq.sec, rq.found, rq.om, list_filter(f.vs, lambda x: x.v = rq.version)[1] AS hit
      FROM f JOIN rq ON rq.page_id = f.page_id AND rq.rn = f.rn + 1))),
fin AS (SELECT page_id, arg_max(c, rn) AS c, arg_max(t, rn) AS t, arg_max(m, rn) AS m, arg_max(vs, rn) AS vs, max(saves) AS saves, arg_max(mine, rn) AS mine FROM f GROUP BY page_id HAVING max(saves) > 0),
src AS (SELECT page_id, CAST(version AS VARCHAR) AS s, content, CASE WHEN NOT legacy_format THEN post_title END AS post_title FROM page_versions UNION ALL SELECT id, 'before', post_content, post_title FROM posts),
mt AS (SELECT page_id, CAST(version AS VARCHAR) AS s, je.key AS meta_key, json_extract_string(je.value, '$') AS meta_value FROM page_versions, json_each(seo_meta_json) je WHERE NOT legacy_format UNION ALL SELECT page_id, 'before', meta_key, meta_value FROM old),
ly AS (SELECT page_id, unnest(m) AS s, unnest(range(1, len(m) + 1)) AS i FROM fin),
sn AS (SELECT page_id, saves, mine, unnest(vs) AS x FROM fin)
SELECT 'log' AS tbl, CAST(page_id AS BIGINT) AS page_id, CAST(request_id AS VARCHAR) AS item, concat_ws('|', status, CAST(version AS VARCHAR), CAST(restored AS VARCHAR)) AS value FROM f WHERE rn > 0
UNION ALL SELECT 'posts', fin.page_id, 'post', md5(a.content) || '|' || b.post_title FROM fin JOIN src a ON a.page_id = fin.page_id AND a.s = fin.c JOIN src b ON b.page_id = fin.page_id AND b.s = fin.t
UNION ALL SELECT 'meta', ly.page_id, mt.meta_key, arg_max(mt.meta_value, i) FROM ly JOIN mt ON mt.page_id = ly.page_id AND mt.s = ly.s GROUP BY ly.page_id, mt.meta_key
UNION ALL SELECT 'versions', sn.page_id, CAST(x.v AS VARCHAR), concat_ws('|', md5(a.content), b.post_title, CAST(saves AS VARCHAR)) FROM sn JOIN src a ON a.page_id = sn.page_id AND a.s = x.c JOIN src b ON b.page_id = sn.page_id AND b.s = x.t
  WHERE list_contains(mine, x.v)"""


@query("rollback", oracle=ROLLBACK_SQL, views=("posts", "page_versions", "postmeta"))
def rollback(t):
    """Rollbacks of a batch in sequence: log, restored pages and meta, versions saved first (also ones restored later in the batch)."""
    checkpoint_dir(t.spark)
    out = rollback_batch(_asked(t), t.posts, t.postmeta, _stored(t))
    one = lambda tbl, item, value: out[tbl].select(F.lit(tbl).alias("tbl"), F.col("page_id").cast("bigint").alias("page_id"), item.cast("string").alias("item"), value.alias("value"))
    return one("log", F.col("request_id"), F.concat_ws("|", "status", "version", F.col("seo_meta_restored").cast("string"))).unionByName(
        one("posts", F.lit("post"), F.concat(F.md5("content"), F.lit("|"), "post_title"))).unionByName(
        one("meta", F.col("meta_key"), F.col("meta_value"))).unionByName(
        one("versions", F.col("version"), F.concat_ws("|", F.md5("content"), "post_title", "n_saves")))


# -- partial SEO updates ---------------------------------------------------------------------------------

_FIELD_OPS_SQL = REPLAY_SQL[REPLAY_SQL.index("fl AS ("):REPLAY_SQL.index("pub_op AS (")].rstrip().rstrip(",")
SEO_WRITES_SQL = f"""WITH r AS ({SEO_REQ.replace('STRING', 'VARCHAR')}), {FLAGS_SQL}, {KEYS_SQL},
al AS (SELECT r.*, p.post_title, p.post_content, CAST(r.post_id AS BIGINT) AS page_id, CAST(r.post_id AS VARCHAR) AS slug, row_number() OVER (PARTITION BY r.post_id ORDER BY requested_at, request_id) AS rn,
    ap.seo_plugin AS plugin, strftime(requested_at, '%Y-%m-%d %H:%M:%S') AS tm FROM r JOIN posts p ON p.id = r.post_id JOIN ap ON ap.id = r.post_id),
rr AS (SELECT page_id, slug, rn, plugin, tm, meta_title AS title, meta_description, focus_keyword, canonical, og_title, og_description, og_image, NULL AS twitter_title, NULL AS twitter_description, []::VARCHAR[] AS kws
  FROM al WHERE coalesce(meta_title, meta_description, focus_keyword, canonical, og_title, og_description, og_image) IS NOT NULL),
{_FIELD_OPS_SQL},
ops AS (SELECT * FROM seo_op UNION ALL SELECT page_id, slug, rn, 20, unnest(['_echo5_structured_data', '_echo5_schemas']), 'set', unnest([schema, '{{"main":' || schema || '}}']) FROM al WHERE schema IS NOT NULL
  UNION ALL SELECT page_id, slug, rn, 20, unnest(['_echo5_last_seo_update', '_echo5_seo_update_source']), 'set', unnest([tm, 'manager_api']) FROM al),
cur AS (SELECT post_id, meta_key, arg_min(meta_value, meta_id) AS v FROM postmeta GROUP BY post_id, meta_key),
la AS (SELECT page_id, any_value(post_title) AS post_title, any_value(post_content) AS post_content, arg_max(page_title, rn) FILTER (page_title IS NOT NULL) AS page_title, arg_max(schema, rn) FILTER (schema IS NOT NULL) AS schema FROM al GROUP BY page_id),
je AS (SELECT page_id, e.key, e.value FROM la, json_each(CASE WHEN json_exists(schema, '$."@type"') THEN '{{"main":' || schema || '}}' ELSE schema END) e WHERE schema IS NOT NULL),
bl AS (SELECT page_id, chr(10) || '<!-- ECHO5:START SCHEMA -->' || chr(10) || string_agg('<script type="application/ld+json">' || chr(10) || {PRETTY_SQL} || chr(10) || '</script>' || chr(10), '' ORDER BY je.key) || '<!-- ECHO5:END SCHEMA -->' || chr(10) AS block
  FROM je GROUP BY page_id),
ps AS (SELECT la.page_id, coalesce(page_title, post_title) AS title, CASE WHEN block IS NULL THEN post_content WHEN regexp_matches(post_content, {SCHEMA_RE_SQL}) THEN regexp_replace(post_content, {SCHEMA_RE_SQL}, block, 'g')
    ELSE post_content || chr(10) || block END AS content, page_title FROM la LEFT JOIN bl USING (page_id)),
h AS ({REGISTRY['tree_set_h1'].oracle})
SELECT 'meta' AS tbl, post_id AS page_id, meta_key AS item, meta_value AS value FROM ({_final_sql('ops')})
UNION ALL SELECT 'posts', page_id, 'post', title || '|' || md5(content) FROM ps
UNION ALL SELECT 'trees', ps.page_id, page_title, h.action FROM ps JOIN h ON h.page_id = ps.page_id WHERE page_title IS NOT NULL"""


@query("seo_update_batch_writes", oracle=SEO_WRITES_SQL, views=("posts", "postmeta", "site_plugins", "builder_trees"))
def seo_update_batch_writes(t):
    """What a batch of partial SEO updates writes: meta values, posts with title and schema, builder trees with their heading."""
    out = R.seo_update_writes(seo_requests(t), t.posts, t.postmeta, S.active_seo_plugin(t.posts, t.site_plugins), t.builder_trees)
    one = lambda tbl, page, item, value: out[tbl].select(F.lit(tbl).alias("tbl"), F.col(page).cast("bigint").alias("page_id"), item.alias("item"), value.alias("value"))
    heading = F.regexp_extract("tree_json", '"title":"(Page [0-9]+)"', 1)
    return one("meta", "post_id", F.col("meta_key"), F.col("meta_value")).unionByName(one("posts", "post_id", F.lit("post"), F.concat("post_title", F.lit("|"), F.md5("post_content")))).unionByName(
        one("trees", "page_id", heading, F.col("action")))
