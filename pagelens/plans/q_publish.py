"""M7 queries: publish requests, content rewriting, validation, versions, media, upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import media as M
from pagelens.operators import publish as P
from pagelens.operators import seo as S
from pagelens.operators import site as X
from pagelens.operators import versions as V
from pagelens.plans.duck import blen, falsy_sql, tags_only_sql, wc_sql
from pagelens.plans.q_site import BEST_SQL
from pagelens.plans.registry import query


def _payloads(t):
    r = t.publish_requests
    payload = F.to_json(F.struct(
        F.struct("title", "slug", "parent_slug", "update_mode").alias("page"),
        F.struct("html").alias("content"),
        F.struct("meta_description", "focus_keyword").alias("seo"),
        F.from_json("schema_json", "map<string,string>").alias("schema"),
        F.struct(F.concat(F.lit("idem-"), F.col("slug")).alias("idempotency_key")).alias("options")))
    return r.select("request_id", "requested_at", payload.alias("payload"))


@query("read_publish_requests", oracle="""
SELECT request_id, title, slug, 'draft' AS status, parent_slug, update_mode, meta_description, focus_keyword,
  'idem-' || slug AS idempotency_key, false AS skip_validation
FROM publish_requests""", views=("publish_requests",))
def read_publish_requests(t):
    """Publish payloads (JSON) parsed to typed columns with defaults (status draft, update_mode safe)."""
    return P.read_publish_requests(_payloads(t)).select(
        "request_id", "title", "slug", "status", "parent_slug", "update_mode", "meta_description",
        "focus_keyword", "idempotency_key", "skip_validation")


SCORE_SQL = f"""greatest(0, 100
  - CASE WHEN strlen(coalesce(title, '')) < 30 THEN 10 ELSE 0 END - CASE WHEN strlen(coalesce(title, '')) > 60 THEN 5 ELSE 0 END
  - CASE WHEN {falsy_sql('meta_description')} THEN 15 WHEN strlen(meta_description) < 120 THEN 5
         WHEN strlen(meta_description) > 160 THEN 5 ELSE 0 END
  - CASE WHEN {wc_sql(tags_only_sql("coalesce(html, '')"))} < 300 THEN 20
         WHEN {wc_sql(tags_only_sql("coalesce(html, '')"))} < 500 THEN 10 ELSE 0 END
  - CASE WHEN NOT contains(coalesce(html, ''), '<h1') THEN 15 ELSE 0 END
  - CASE WHEN {falsy_sql('focus_keyword')} THEN 10 ELSE 0 END)"""


@query("seo_score", oracle=f"SELECT request_id, CAST({SCORE_SQL} AS INTEGER) AS seo_score FROM publish_requests",
       views=("publish_requests",))
def seo_score(t):
    """SEO score of every publish request (title, description, words, h1, keyword penalties)."""
    r = t.publish_requests
    return r.select("request_id", P.seo_score(F.col("title"), F.col("meta_description"), F.col("html"),
                                              F.col("focus_keyword")).alias("seo_score"))


@query("validate_page", oracle=f"""WITH {BEST_SQL},
v AS (SELECT r.*, best.post_id AS existing_page_id,
  list_filter([CASE WHEN {falsy_sql('title')} OR strlen(coalesce(title, '')) < 10 THEN 'title_too_short' END,
               CASE WHEN {falsy_sql('html')} OR strlen(coalesce(html, '')) < 500 THEN 'content_too_short' END],
              lambda x: x IS NOT NULL) AS issues,
  list_filter([CASE WHEN strlen(coalesce(title, '')) > 60 THEN 'title_too_long' END,
               CASE WHEN {falsy_sql('meta_description')} THEN 'meta_description_missing' END,
               CASE WHEN NOT {falsy_sql('meta_description')} AND strlen(meta_description) < 120 THEN 'meta_description_short' END,
               CASE WHEN NOT {falsy_sql('meta_description')} AND strlen(meta_description) > 160 THEN 'meta_description_long' END,
               CASE WHEN NOT contains(coalesce(html, ''), '<h1') THEN 'no_h1' END,
               CASE WHEN update_mode = 'safe' AND NOT regexp_matches(coalesce(html, ''),
                    '(?s)<!-- ECHO5:START (\\w+) -->.*?<!-- ECHO5:END (\\w+) -->') THEN 'no_section_markers' END],
              lambda x: x IS NOT NULL) AS warnings
  FROM publish_requests r LEFT JOIN best ON best.s = r.slug)
SELECT request_id, len(issues) = 0 AS valid, existing_page_id IS NULL AS would_create,
  existing_page_id IS NOT NULL AS would_update, existing_page_id,
  array_to_string(issues, ',') AS issues, array_to_string(warnings, ',') AS warnings,
  CAST({SCORE_SQL} AS INTEGER) AS seo_score, {blen("coalesce(html, '')")} AS html_length,
  {wc_sql(tags_only_sql("coalesce(html, '')"))} AS word_count,
  CAST(len(regexp_extract_all(coalesce(html, ''), '(?i)<h[1-6]')) AS BIGINT) AS heading_count
FROM v""", views=("posts", "publish_requests"))
def validate_page(t):
    """Dry-run validation of every publish request: issues, warnings, create/update, score, stats."""
    r = t.publish_requests
    existing = X.find_by_slug(r.select("request_id", "slug"), t.posts)
    return P.validate_page(r, existing)


@query("blog_validate", oracle=f"""
SELECT request_id,
  CASE WHEN {falsy_sql('title')} THEN 'title is required' WHEN {falsy_sql('content')} THEN 'content is required' END AS error,
  CASE WHEN (CASE WHEN {falsy_sql('status')} THEN 'publish' ELSE status END) IN ('publish', 'draft')
       THEN (CASE WHEN {falsy_sql('status')} THEN 'publish' ELSE status END) ELSE 'publish' END AS status,
  CASE WHEN {falsy_sql('category_slug')} THEN 'blog' ELSE category_slug END AS category_slug
FROM blog_requests""", views=("blog_requests",))
def blog_validate(t):
    """Blog payload checks: required title/content, status publish|draft, default category."""
    return P.blog_validate(t.blog_requests)


IN_TURN_FOLD = """list_reduce(list_prepend(old, regexp_extract_all(html, '(?s)<!-- ECHO5:START \\w+ -->.*?<!-- ECHO5:END \\w+ -->')), lambda acc, s:
  CASE WHEN regexp_matches(acc, '(?s)<!-- ECHO5:START ' || regexp_extract(s, 'START (\\w+) -->', 1) || ' -->.*?<!-- ECHO5:END '
                                || regexp_extract(s, 'START (\\w+) -->', 1) || ' -->')
       THEN regexp_replace(acc, '(?s)<!-- ECHO5:START ' || regexp_extract(s, 'START (\\w+) -->', 1) || ' -->.*?<!-- ECHO5:END '
                                || regexp_extract(s, 'START (\\w+) -->', 1) || ' -->', s, 'g')
       WHEN contains(acc, '</body>') THEN replace(acc, '</body>', s || chr(10) || '</body>')
       ELSE acc || chr(10) || s END)"""
# Every request of a slug applied to the page in turn: the whole html, or its marked sections.
IN_TURN_SQL = f"""WITH RECURSIVE {BEST_SQL},
rq AS (SELECT r.*, best.post_id, p.post_content AS existing,
    row_number() OVER (PARTITION BY r.slug ORDER BY r.requested_at, r.request_id) AS rn, count(*) OVER (PARTITION BY r.slug) AS n
  FROM publish_requests r LEFT JOIN best ON best.s = r.slug LEFT JOIN posts p ON p.id = best.post_id),
st AS (SELECT *, coalesce(existing, html) AS start FROM rq),
ap(slug, rn, merged) AS (
  SELECT slug, rn, CASE WHEN update_mode <> 'safe' OR NOT regexp_matches(html, '(?s)<!-- ECHO5:START (\\w+) -->.*?<!-- ECHO5:END \\w+ -->') THEN html
      ELSE {IN_TURN_FOLD.replace('list_prepend(old,', 'list_prepend(start,')} END FROM st WHERE rn = 1
  UNION ALL
  SELECT slug, rn, CASE WHEN update_mode <> 'safe' OR NOT regexp_matches(html, '(?s)<!-- ECHO5:START (\\w+) -->.*?<!-- ECHO5:END \\w+ -->') THEN html
      ELSE {IN_TURN_FOLD} END
  FROM (SELECT st.*, ap.merged AS old FROM ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn + 1)),
mg AS (SELECT st.*, ap.merged FROM ap JOIN st ON st.slug = ap.slug AND st.rn = ap.rn WHERE st.rn = st.n)"""


def _merged():
    """The page's html after all requests of the batch (a new page starts from the first request's html)."""
    return P.fold_sections(F.coalesce("base_html", "existing", "first_html"), F.col("sections"))


def _batch(t):
    r = P.batch_updates(t.publish_requests)
    found = X.find_by_slug(r, t.posts)
    return found.join(t.posts.select(F.col("id").alias("post_id"), F.col("post_content").alias("existing")), "post_id", "left")


@query("safe_update", oracle=f"""{IN_TURN_SQL}
SELECT request_id, post_id, md5(merged) AS merged_md5, {blen('merged')} AS merged_length FROM mg WHERE post_id IS NOT NULL""",
       views=("posts", "publish_requests"))
def safe_update(t):
    """Existing pages after the marked sections of every request of the batch, in order of the requests."""
    e = _batch(t).filter(F.col("post_id").isNotNull())
    merged = _merged()
    return e.select("request_id", "post_id", F.md5(merged).alias("merged_md5"),
                    F.octet_length(merged).cast("bigint").alias("merged_length"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WRAP_SQL = (f"CASE WHEN contains(html, 'echo5-tailwind-content') THEN html ELSE "
            f"{_sql_str(P.WRAP_PREFIX)} || {_sql_str(P.WRAP_OPEN)} || html || {_sql_str(P.WRAP_CLOSE)} END")


@query("wrap_content", oracle=f"SELECT request_id, md5({WRAP_SQL}) AS wrapped_md5, {blen(WRAP_SQL)} AS wrapped_length FROM publish_requests",
       views=("publish_requests",))
def wrap_content(t):
    """Style wrapper added to every request's html (idempotent on already wrapped html)."""
    w = P.wrap_content(F.col("html"))
    return t.publish_requests.select("request_id", F.md5(w).alias("wrapped_md5"),
                                     F.octet_length(w).cast("bigint").alias("wrapped_length"))


# A flat object over several lines, four blanks deep.
PRETTY_SQL = """'{' || chr(10) || (SELECT string_agg('    "' || f.key || '": ' || f.value, ',' || chr(10)) FROM json_each(je.value) f)
  || chr(10) || '}'"""


@query("inject_schema", oracle="""
WITH e AS (SELECT request_id, html, schema_json FROM publish_requests),
s AS (SELECT e.request_id, string_agg('<script type="application/ld+json">' || chr(10) || __PRETTY__ || chr(10) || '</script>' || chr(10), ''
        ORDER BY je.key) AS scripts
      FROM e, json_each(e.schema_json) je WHERE je.value IS NOT NULL AND CAST(je.value AS VARCHAR) NOT IN ('', '0', 'null', '{}', '[]', 'false')
      GROUP BY e.request_id),
b AS (SELECT e.request_id, e.html, e.schema_json,
        chr(10) || '<!-- ECHO5:START SCHEMA -->' || chr(10) || coalesce(s.scripts, '') || '<!-- ECHO5:END SCHEMA -->' || chr(10) AS block
      FROM e LEFT JOIN s ON s.request_id = e.request_id)
SELECT request_id, md5(CASE WHEN schema_json IS NULL OR len(json_keys(schema_json)) = 0 THEN html
  WHEN regexp_matches(html, '(?s)<!-- ECHO5:START SCHEMA -->.*?<!-- ECHO5:END SCHEMA -->')
  THEN regexp_replace(html, '(?s)<!-- ECHO5:START SCHEMA -->.*?<!-- ECHO5:END SCHEMA -->', block, 'g')
  ELSE html || block END) AS content_md5
FROM b""".replace("__PRETTY__", PRETTY_SQL), views=("publish_requests",))
def inject_schema(t):
    """JSON-LD SCHEMA section injected into every request's html (replace or append)."""
    r = t.publish_requests
    out = P.inject_schema(F.col("html"), F.from_json("schema_json", "map<string,string>"))
    return r.select("request_id", F.md5(out).alias("content_md5"))


@query("inject_gallery", oracle="""
WITH g AS (SELECT request_id, html,
  chr(10) || '<!-- ECHO5:START GALLERY -->' || chr(10) || '<div class="g">' || CAST(request_id AS VARCHAR) || '</div>'
  || chr(10) || '<!-- ECHO5:END GALLERY -->' || chr(10) AS sec FROM publish_requests)
SELECT request_id, md5(CASE
  WHEN regexp_matches(html, '(?s)<!-- ECHO5:START GALLERY -->.*?<!-- ECHO5:END GALLERY -->')
  THEN regexp_replace(html, '(?s)<!-- ECHO5:START GALLERY -->.*?<!-- ECHO5:END GALLERY -->', sec, 'g')
  WHEN contains(html, '<!-- ECHO5:START FAQ -->') THEN replace(html, '<!-- ECHO5:START FAQ -->', sec || chr(10) || '<!-- ECHO5:START FAQ -->')
  WHEN contains(html, '<!-- ECHO5:START SCHEMA -->') THEN replace(html, '<!-- ECHO5:START SCHEMA -->', sec || chr(10) || '<!-- ECHO5:START SCHEMA -->')
  ELSE html || sec END) AS content_md5
FROM g""", views=("publish_requests",))
def inject_gallery(t):
    """GALLERY section injected into every request's html (replace, before FAQ/SCHEMA, or append)."""
    r = t.publish_requests
    g = F.concat(F.lit('<div class="g">'), F.col("request_id").cast("string"), F.lit("</div>"))
    return r.select("request_id", F.md5(P.inject_gallery(F.col("html"), g)).alias("content_md5"))


def _esc_sql(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), '''', '&#039;')")


@query("gallery_html", oracle=f"""
WITH a AS (SELECT post_parent, id, source_url, alt FROM attachments WHERE post_parent > 0)
SELECT post_parent, md5('<div class="echo5-gallery grid grid-cols-1 md:grid-cols-2 lg:grid-cols-3 gap-4">' ||
  string_agg('<figure class="echo5-gallery-item overflow-hidden rounded-lg shadow-lg"><a href="' || source_url ||
    '" class="block" data-lightbox="echo5-gallery"><img src="' || source_url || '" alt="' || {_esc_sql("coalesce(alt, '')")} ||
    '" loading="lazy" class="w-full h-auto object-cover transition-transform hover:scale-105"></a></figure>', '' ORDER BY id)
  || '</div>') AS gallery_md5
FROM a GROUP BY post_parent""", views=("attachments",))
def gallery_html(t):
    """Gallery grid markup of each page's attached images (ordered by attachment id)."""
    a = t.attachments.filter(F.col("post_parent") > 0)
    imgs = a.groupBy("post_parent").agg(F.array_sort(F.collect_list(F.struct(
        F.col("id"), F.col("source_url").alias("url"), "alt", F.lit(None).cast("string").alias("caption")))).alias("imgs"))
    return imgs.select("post_parent", F.md5(P.gallery_html(F.col("imgs"))).alias("gallery_md5"))


IMG_T = "array<struct<url:string,alt:string>>"


@query("inline_image_markers", oracle="""
WITH b AS (SELECT request_id, content, featured_is_first_inline AS ff,
  from_json(inline_images_json, '[{"url":"VARCHAR","alt":"VARCHAR"}]') AS imgs FROM blog_requests),
s1 AS (SELECT *, CASE WHEN len(imgs) >= 1 THEN CASE WHEN ff THEN replace(content, '<!-- image:1 -->', '')
  WHEN coalesce(imgs[1].url, '') <> '' THEN replace(content, '<!-- image:1 -->', '<figure><img src="' || imgs[1].url || '" alt="' ||
    replace(replace(replace(replace(replace(coalesce(imgs[1].alt, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#039;') || '" /></figure>')
  ELSE content END ELSE content END AS c1 FROM b),
s2 AS (SELECT *, CASE WHEN len(imgs) >= 2 AND coalesce(imgs[2].url, '') <> '' THEN replace(c1, '<!-- image:2 -->', '<figure><img src="' ||
    imgs[2].url || '" alt="' || replace(replace(replace(replace(replace(coalesce(imgs[2].alt, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#039;')
    || '" /></figure>') ELSE c1 END AS c2 FROM s1),
s3 AS (SELECT *, CASE WHEN len(imgs) >= 3 AND coalesce(imgs[3].url, '') <> '' THEN replace(c2, '<!-- image:3 -->', '<figure><img src="' ||
    imgs[3].url || '" alt="' || replace(replace(replace(replace(replace(coalesce(imgs[3].alt, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#039;')
    || '" /></figure>') ELSE c2 END AS c3 FROM s2)
SELECT request_id, c3 AS content FROM s3""", views=("blog_requests",))
def inline_image_markers(t):
    """Inline image markers of every blog request replaced by figures (featured first removed)."""
    b = t.blog_requests
    imgs = F.from_json("inline_images_json", IMG_T)
    return b.select("request_id", P.inline_image_markers(F.col("content"), imgs,
                                                         F.col("featured_is_first_inline")).alias("content"))


@query("tailwind_section_style", oracle="""
WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, 'class="([^"]*)"', 1)) AS cls FROM enriched_pages)
SELECT page_id, cls,
  CASE WHEN TRY_CAST(regexp_extract(cls, '(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\\d+)', 1) AS INTEGER) >= 800 THEN '#1f2937'
       WHEN TRY_CAST(regexp_extract(cls, '(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\\d+)', 1) AS INTEGER) >= 600 THEN '#4b5563'
       WHEN TRY_CAST(regexp_extract(cls, '(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\\d+)', 1) AS INTEGER) >= 100 THEN '#f3f4f6' END
    AS background_color,
  CAST(TRY_CAST(regexp_extract(cls, '(?i)py-(\\d+)', 1) AS INTEGER) * 4 AS VARCHAR) AS padding_y
FROM c""", views=("enriched_pages",))
def tailwind_section_style(t):
    """Section settings (gray background shade, py-N padding) from every class attribute."""
    c = t.enriched_pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('class="([^"]*)"'), 1)).alias("cls"))
    st = P.tailwind_section_style(F.col("cls"))
    return c.select("page_id", "cls", st["background_color"].alias("background_color"),
                    st["padding_y"].alias("padding_y"))


# --- versions -----------------------------------------------------------------

@query("version_history", oracle="""
SELECT page_id, version, strftime(to_timestamp(version), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp,
  CAST(strlen(content) AS BIGINT) AS content_length,
  CAST(row_number() OVER (PARTITION BY page_id ORDER BY version DESC) AS INTEGER) AS rank
FROM page_versions""", views=("page_versions",))
def version_history(t):
    """Snapshots of every page newest first, with ISO time and stored length."""
    return V.version_history(t.page_versions).withColumn("rank", F.col("rank").cast("int"))


@query("version_retention", oracle="""
SELECT page_id, version FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY version DESC) AS r FROM page_versions)
WHERE r <= 3""", views=("page_versions",))
def version_retention(t):
    """Snapshots kept with keep=3 (newest three per page)."""
    return V.version_retention(t.page_versions, keep=3).select("page_id", "version")


@query("version_retention_compat", oracle="""
SELECT page_id, version FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY version DESC) AS r FROM page_versions)
WHERE r <= 9""", views=("page_versions",))
def version_retention_compat(t):
    """Snapshots kept by the reference's keep=10 cleanup (its pattern also matches the count key: 9 stay)."""
    return V.version_retention(t.page_versions, keep=10, compat=True).select("page_id", "version")


@query("version_timestamp", oracle="""
SELECT page_id, '_echo5_version_' || CAST(version AS VARCHAR) AS meta_key,
  strftime(to_timestamp(version), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp
FROM page_versions""", views=("page_versions",))
def version_timestamp(t):
    """ISO time read back from every version meta key."""
    k = F.concat(F.lit(V.VERSION_KEY_PREFIX), F.col("version").cast("string"))
    return t.page_versions.select("page_id", k.alias("meta_key"), V.version_timestamp(k).alias("timestamp"))


# --- robots ---

@query("robots_meta", oracle=f"""WITH {__import__('pagelens.plans.q_seo', fromlist=['x']).FLAGS_SQL},
j AS (SELECT ap.id, ap.seo_plugin, p.post_status <> 'publish' AS ni, ap.id % 2 = 1 AS nf FROM ap JOIN posts p ON p.id = ap.id)
SELECT id, seo_plugin, '_yoast_wpseo_meta-robots-noindex' AS meta_key, CASE WHEN ni THEN '1' ELSE '' END AS meta_value FROM j WHERE seo_plugin = 'yoast'
UNION ALL SELECT id, seo_plugin, '_yoast_wpseo_meta-robots-nofollow', CASE WHEN nf THEN '1' ELSE '' END FROM j WHERE seo_plugin = 'yoast'
UNION ALL SELECT id, seo_plugin, 'rank_math_robots', '[' || array_to_string(list_filter([CASE WHEN ni THEN '"noindex"' END,
  CASE WHEN nf THEN '"nofollow"' END], lambda x: x IS NOT NULL), ',') || ']' FROM j WHERE seo_plugin = 'rankmath'
UNION ALL SELECT id, seo_plugin, '_aioseo_noindex', CASE WHEN ni THEN '1' ELSE '0' END FROM j WHERE seo_plugin = 'aioseo'
UNION ALL SELECT id, seo_plugin, '_aioseo_nofollow', CASE WHEN nf THEN '1' ELSE '0' END FROM j WHERE seo_plugin = 'aioseo'
UNION ALL SELECT id, seo_plugin, '_seopress_robots_index', CASE WHEN ni THEN '1' ELSE '0' END FROM j WHERE seo_plugin = 'seopress'
UNION ALL SELECT id, seo_plugin, '_seopress_robots_follow', CASE WHEN nf THEN '1' ELSE '0' END FROM j WHERE seo_plugin = 'seopress'
UNION ALL SELECT id, seo_plugin, '_echo5_robots', CASE WHEN ni THEN 'noindex' ELSE 'index' END || ',' ||
  CASE WHEN nf THEN 'nofollow' ELSE 'follow' END FROM j WHERE seo_plugin NOT IN ('yoast', 'rankmath', 'aioseo', 'seopress')""",
       views=("posts", "site_plugins"))
def robots_meta(t):
    """Robots meta writes in each post's active plugin format (noindex if not published, nofollow odd ids)."""
    active = S.active_seo_plugin(t.posts, t.site_plugins)
    j = active.join(t.posts.select(F.col("id").cast("bigint").alias("id"), "post_status"), "id")
    r = P.robots_meta(F.col("seo_plugin"), F.col("post_status") != "publish", F.col("id") % 2 == 1)
    return j.select("id", "seo_plugin", F.explode(r).alias("x")).select("id", "seo_plugin", "x.meta_key", "x.meta_value")


SCHEMA_RE_SQL = "'(?s)<!-- ECHO5:START SCHEMA -->.*?<!-- ECHO5:END SCHEMA -->'"


# --- media ------------------------------------------------------------------------

MIME_SQL = """CASE WHEN mime_type IN ('image/jpeg', 'image/png', 'image/gif', 'image/webp') THEN mime_type
    WHEN upper(head_hex) LIKE 'FFD8FF%' THEN 'image/jpeg' WHEN upper(head_hex) LIKE '89504E470D0A1A0A%' THEN 'image/png'
    WHEN upper(head_hex) LIKE '474946383761%' OR upper(head_hex) LIKE '474946383961%' THEN 'image/gif'
    WHEN upper(head_hex) LIKE '52494646________57454250%' THEN 'image/webp' ELSE mime_type END"""


@query("image_accept", oracle=f"""
WITH a AS (SELECT * REPLACE ({MIME_SQL} AS mime_type) FROM attachments)
SELECT id, CASE WHEN NOT coalesce(regexp_matches(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^\\s/?#]+[^\\s]*$'), false) THEN 'invalid_url'
  WHEN mime_type NOT IN ('image/jpeg', 'image/png', 'image/gif', 'image/webp') THEN 'invalid_type'
  WHEN n_bytes > 10485760 THEN 'file_too_large' END AS reason,
  CASE mime_type WHEN 'image/png' THEN 'png' WHEN 'image/gif' THEN 'gif' WHEN 'image/webp' THEN 'webp' ELSE 'jpg' END AS extension
FROM a""", views=("attachments",))
def image_accept(t):
    """Upload checks of every attachment: url, type (declared or told from the first bytes), size; extension."""
    return M.image_accept(t.attachments).select("id", "reason", "extension")


@query("image_filename", oracle="""
WITH a AS (SELECT id, source_url AS u, alt,
  CASE {mime} WHEN 'image/png' THEN 'png' WHEN 'image/gif' THEN 'gif' WHEN 'image/webp' THEN 'webp' ELSE 'jpg' END AS ext,
  regexp_replace(regexp_extract(regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1),
                 '\\.[^.]*$', '') AS b FROM attachments)
SELECT id, CASE WHEN alt IS NOT NULL AND alt NOT IN ('', '0')
    THEN trim(regexp_replace(regexp_replace(lower(substr(alt, 1, 50)), '[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '-')
    ELSE CASE WHEN b IS NULL OR b IN ('', '0') OR strlen(b) < 3 THEN 'echo5-image-' || substr(md5(u), 1, 8) ELSE b END END
  || '-' || substr(md5(u || '1709251200'), 1, 6) || '.' || ext AS filename
FROM a""".replace("{mime}", MIME_SQL), views=("attachments",))
def image_filename(t):
    """SEO file name of every attachment (alt-based or url-based, unique suffix at a fixed time)."""
    a = M.image_accept(t.attachments)
    return a.select("id", M.image_filename(F.col("source_url"), F.col("alt"), F.col("extension"),
                                           F.lit(1709251200)).alias("filename"))


@query("base64_image", oracle="""
WITH d AS (SELECT doc_id, text, to_base64(encode(text)) AS raw FROM documents),
i AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN 'data:image/png;base64,' || raw WHEN 1 THEN raw
                              ELSE raw || '!' END AS data FROM d),
p AS (SELECT doc_id, text, data, regexp_extract(data, '^data:(image/\\w+);base64,', 0) AS prefix FROM i),
q AS (SELECT doc_id, text, CASE WHEN prefix <> '' THEN regexp_extract(data, '^data:(image/\\w+);base64,', 1) ELSE 'image/jpeg' END AS mime,
        regexp_replace(CASE WHEN prefix <> '' THEN substr(data, length(prefix) + 1) ELSE data END, '\\s', '', 'g') AS p FROM p),
r AS (SELECT *, regexp_replace(p, '=+$', '') AS core FROM q),
s AS (SELECT *, length(p) - length(core) AS pad FROM r),
v AS (SELECT *, regexp_matches(core, '^[A-Za-z0-9+/]*$') AND pad <= 2 AND length(core) % 4 <> 1
        AND (pad = 0 OR (length(core) + pad) % 4 = 0) AS valid FROM s),
b AS (SELECT *, CASE WHEN valid THEN try(from_base64(core || repeat('=', (4 - length(core) % 4) % 4))) END AS bin FROM v)
SELECT doc_id, coalesce(bin IS NOT NULL AND octet_length(bin) >= 100, false) AS ok, mime,
  CAST(octet_length(bin) AS BIGINT) AS n_bytes,
  CASE WHEN bin IS NOT NULL AND octet_length(bin) >= 100 THEN '2024-03-01-' ||
    CASE WHEN text IS NOT NULL AND text NOT IN ('', '0')
         THEN substr(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40) ELSE 'blog-image' END
    || '-' || substr(md5(bin), 1, 6) || '.' ||
    CASE mime WHEN 'image/png' THEN 'png' WHEN 'image/gif' THEN 'gif' WHEN 'image/webp' THEN 'webp' ELSE 'jpg' END END AS filename
FROM b""")
def base64_image(t):
    """Decode base64 image payloads (data URI or raw): validity, type, size, file name."""
    d = t.documents.select("doc_id", "text")
    raw = F.base64(F.encode(F.col("text"), "UTF-8"))
    data = (F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("data:image/png;base64,"), raw))
            .when(F.col("doc_id") % 3 == 1, raw).otherwise(F.concat(raw, F.lit("!"))))
    b = M.base64_image(data, F.col("text"), F.to_timestamp(F.lit("2024-03-01 00:00:00")))
    return d.select("doc_id", b["ok"].alias("ok"), b["mime"].alias("mime"), b["n_bytes"].alias("n_bytes"),
                    b["filename"].alias("filename"))


def _upload_requests(t):
    imgs = t.enriched_pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('(?i)src="([^"]+)"'), 1)).alias("src"))
    return imgs.select(F.col("page_id").alias("batch_id"),
                       F.when(F.col("src").startswith("/"), F.concat(F.lit("https://cdn.example.com"), F.col("src")))
                       .otherwise(F.col("src")).alias("url"))


UPLOAD_SQL = """u AS (SELECT page_id AS batch_id, CASE WHEN starts_with(src, '/') THEN 'https://cdn.example.com' || src ELSE src END AS url
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)src="([^"]+)"', 1)) AS src FROM enriched_pages)),
lib AS (SELECT url_hash, min(id) AS existing_id FROM attachments GROUP BY url_hash)"""


@query("media_dedup", oracle=f"""WITH {UPLOAD_SQL}
SELECT u.batch_id, u.url, lib.existing_id, lib.existing_id IS NOT NULL AS duplicate
FROM u LEFT JOIN lib ON lib.url_hash = md5(u.url)""", views=("enriched_pages", "attachments"))
def media_dedup(t):
    """Requested image urls already in the library (md5 of url = stored hash)."""
    return M.media_dedup(_upload_requests(t), t.attachments).select("batch_id", "url", "existing_id", "duplicate")


@query("media_upload_summary", oracle=f"""WITH {UPLOAD_SQL},
o AS (SELECT u.batch_id, u.url, CASE WHEN NOT coalesce(regexp_matches(u.url, '^[A-Za-z][A-Za-z0-9+.-]*://[^\\s/?#]+[^\\s]*$'), false)
  THEN 'failed' WHEN lib.existing_id IS NOT NULL THEN 'duplicate' ELSE 'success' END AS outcome
  FROM u LEFT JOIN lib ON lib.url_hash = md5(u.url))
SELECT batch_id, outcome, CAST(count(*) AS BIGINT) AS n FROM o GROUP BY batch_id, outcome""", views=("enriched_pages", "attachments"))
def media_upload_summary(t):
    """Per page upload batch: success / duplicate / failed counts."""
    return M.media_upload_summary(_upload_requests(t), t.attachments)


@query("orphan_media", oracle="""
WITH c AS (SELECT id, source_url, post_date FROM attachments WHERE post_parent = 0 AND uploaded_by_us
           AND post_date < TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 30 DAY)
SELECT * FROM c WHERE id NOT IN (SELECT TRY_CAST(meta_value AS BIGINT) FROM postmeta
                                 WHERE meta_key = '_thumbnail_id' AND TRY_CAST(meta_value AS BIGINT) IS NOT NULL)
ORDER BY post_date DESC, id DESC LIMIT 100
""", views=("attachments", "postmeta"))
def orphan_media(t):
    """Orphaned uploads to delete: the newest 100 older than 30 days that are no featured image."""
    return M.orphan_media(t.attachments, t.postmeta, "2024-03-01 00:00:00", 30, 100)


def _image_meta_sql() -> str:
    from pagelens.plans.registry import REGISTRY
    return (f"SELECT page_id, pos, src, alt, width, height, has_alt FROM ({REGISTRY['tree_images'].oracle}) q")


@query("image_meta_join", oracle=_image_meta_sql())
def image_meta_join(t):
    """Builder image objects joined to attachments for alt/width/height (alt falls back to the widget's)."""
    from pagelens.operators import tree as TR
    return TR.tree_images(TR.tree_nodes(t.builder_trees), t.attachments).select(
        "page_id", "pos", "src", "alt", "width", "height", "has_alt")
