"""M1/M4 queries: scans, the export record, text/URL functions, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import text as T
from pagelens.functions import url as U
from pagelens.operators import export as X
from pagelens.plans.duck import blen, host_sql, path_sql, strip_sql, tags_only_sql, wc_sql
from pagelens.plans.registry import query

MINIMAL_SQL = f"""
SELECT CAST(id AS BIGINT) AS id, post_type AS type, url,
  CASE WHEN path IN ('/', '') THEN '__root__' ELSE ltrim(path, '/') END AS slug, path,
  post_title AS title, post_status AS status,
  CAST(post_date AS TIMESTAMP) AS published_date, CAST(post_modified AS TIMESTAMP) AS modified_date
FROM (SELECT *, {path_sql('url')} AS path FROM posts)
"""


@query("load_pages", oracle="""
SELECT CAST(id AS BIGINT) AS id, site_id, post_type, post_title, menu_order FROM posts
WHERE post_type IN ('page', 'post') AND post_status = 'publish'
""", views=("posts",))
def load_pages(t):
    """Published pages and posts (type and status filters pushed into the scan)."""
    return X.load_pages(t.posts).select(F.col("id").cast("bigint").alias("id"), "site_id",
                                        "post_type", "post_title", "menu_order")


@query("page_minimal", oracle=MINIMAL_SQL, views=("posts",))
def page_minimal(t):
    """Nine base export columns of every post."""
    return X.page_minimal(t.posts)


@query("status_filter", oracle="""
SELECT CAST(id AS BIGINT) AS id, post_status FROM posts
WHERE post_status IN ('publish', 'draft', 'pending', 'private')
""", views=("posts",))
def status_filter(t):
    """Editable statuses (publish, draft, pending, private)."""
    return X.status_filter(t.posts, include_unpublished=True).select(
        F.col("id").cast("bigint").alias("id"), "post_status")


@query("single_page", oracle=f"""
SELECT m.* FROM ({MINIMAL_SQL}) m WHERE m.id = 7 AND m.type = 'page'
""", views=("posts",))
def single_page(t):
    """One page by id (7); empty when that id is not a page."""
    return X.page_minimal(X.single_page(t.posts, 7))


@query("fields_switch", oracle=f"""
SELECT m.*, {wc_sql('c.txt')} AS word_count,
  CAST(ceil({wc_sql('c.txt')} / 200) AS BIGINT) AS reading_time,
  contains(c.post_content, '<!-- wp:') AS has_blocks
FROM ({MINIMAL_SQL}) m JOIN (SELECT id, post_content, {strip_sql('post_content')} AS txt FROM posts) c
  ON m.id = c.id
""", views=("posts",))
def fields_switch(t):
    """fields=all with content: base columns + word count, reading time, block flag."""
    return X.fields_switch(t.posts, "all", True).drop("excerpt")


@query("strip_tags", oracle=f"SELECT page_id, {strip_sql('html')} AS text FROM pages")
def strip_tags(t):
    """Tag-stripped text of every page (script/style bodies removed)."""
    return t.pages.select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query("word_count", oracle=f"""
SELECT page_id, {wc_sql(strip_sql('html'))} AS word_count FROM pages
""")
def word_count(t):
    """str_word_count of each page's text (ASCII letters, ' and -)."""
    return t.pages.select("page_id", T.word_count(T.strip_tags(F.col("html"))).alias("word_count"))


@query("reading_time", oracle=f"""
SELECT page_id, CAST(ceil({wc_sql(strip_sql('html'))} / 200) AS BIGINT) AS reading_time FROM pages
""")
def reading_time(t):
    """ceil(words / 200) per page."""
    wc = T.word_count(T.strip_tags(F.col("html")))
    return t.pages.select("page_id", T.reading_time(wc).alias("reading_time"))


@query("excerpt", oracle=f"""
WITH w AS (
  SELECT id, post_excerpt,
    list_filter(string_split_regex({strip_sql('post_content')}, '[\\n\\r\\t ]+'), lambda x: x <> '') AS ws
  FROM posts)
SELECT CAST(id AS BIGINT) AS id,
  CASE WHEN post_excerpt IS NOT NULL AND post_excerpt <> '' THEN post_excerpt
       ELSE array_to_string(list_slice(ws, 1, 30), ' ') || CASE WHEN len(ws) > 30 THEN '&hellip;' ELSE '' END
  END AS excerpt
FROM w
""", views=("posts",))
def excerpt(t):
    """Own excerpt, else the first 30 words of the text + '&hellip;' when cut."""
    return t.posts.select(F.col("id").cast("bigint").alias("id"),
                          T.excerpt(F.col("post_excerpt"), F.col("post_content")).alias("excerpt"))


@query("normalize_text", oracle="""
SELECT doc_id, regexp_replace(text, '[^a-z0-9]+', '', 'g') AS norm FROM documents
""")
def normalize_text(t):
    """Duplicate key of each document's text: only [a-z0-9] kept (capitals lost)."""
    return t.documents.select("doc_id", T.normalize_text(F.col("text")).alias("norm"))


@query("has_blocks", oracle="""
SELECT CAST(id AS BIGINT) AS id, contains(post_content, '<!-- wp:') AS has_blocks FROM posts
""", views=("posts",))
def has_blocks(t):
    """Block-editor content flag per post."""
    return t.posts.select(F.col("id").cast("bigint").alias("id"),
                          T.has_blocks(F.col("post_content")).alias("has_blocks"))


@query("content_stats", oracle=f"""
SELECT page_id, {blen('html')} AS html_length, {wc_sql(tags_only_sql('html'))} AS word_count,
  CAST(len(regexp_extract_all(html, '(?i)<h[1-6]')) AS BIGINT) AS heading_count
FROM enriched_pages
""", views=("enriched_pages",))
def content_stats(t):
    """html bytes, words (tags removed) and heading openings per page."""
    return t.enriched_pages.select("page_id", H.content_stats(F.col("html")).alias("s")).select("page_id", "s.*")


@query("url_slug_path", oracle=f"""
SELECT page_id, path, CASE WHEN path IN ('/', '') THEN '__root__' ELSE ltrim(path, '/') END AS slug
FROM (SELECT page_id, {path_sql('url')} AS path FROM pages)
""")
def url_slug_path(t):
    """Path and slug of every page url."""
    p = U.url_path(F.col("url"))
    return t.pages.select("page_id", p.alias("path"), U.url_slug(p).alias("slug"))


@query("url_host", oracle=f"""
SELECT page_id, {host_sql('url')} AS host FROM pages
""")
def url_host(t):
    """Host of every page url."""
    return t.pages.select("page_id", U.url_host(F.col("url")).alias("host"))


@query("url_hash", oracle="SELECT page_id, md5(url) AS url_hash FROM pages")
def url_hash(t):
    """md5 of every page url."""
    return t.pages.select("page_id", U.url_hash(F.col("url")).alias("url_hash"))


HEADINGS_SQL = """
SELECT page_id, level, CAST(pos AS BIGINT) AS pos, {strip} AS text FROM (
  SELECT page_id, 'h' || CAST(lv AS VARCHAR) AS level,
    unnest(regexp_extract_all(html, '(?is)<h' || CAST(lv AS VARCHAR) || '[^>]*>(.*?)</h' || CAST(lv AS VARCHAR) || '>', 1)) AS raw,
    generate_subscripts(regexp_extract_all(html, '(?is)<h' || CAST(lv AS VARCHAR) || '[^>]*>(.*?)</h' || CAST(lv AS VARCHAR) || '>', 1), 1) AS pos
  FROM {src}, range(1, 7) r(lv))
"""


@query("heading_map", oracle=HEADINGS_SQL.format(strip=strip_sql("raw"), src="pages"))
def heading_map(t):
    """Heading rows (page, level, pos, text) from every page's h1..h6 map."""
    return X.page_headings(t.pages)


@query("heading_map_enriched", oracle=HEADINGS_SQL.format(strip=strip_sql("raw"), src="enriched_pages"),
       views=("enriched_pages",))
def heading_map_enriched(t):
    """Heading rows over pages with h2/h3 (nested tags inside headings)."""
    return X.page_headings(t.enriched_pages)


LINKS_SQL = """
WITH m AS (
  SELECT page_id, {host} AS site_host,
    unnest(regexp_extract_all(html, '(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1)) AS url,
    unnest(regexp_extract_all(html, '(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 2)) AS raw,
    generate_subscripts(regexp_extract_all(html, '(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>', 1), 1) AS pos
  FROM {src})
SELECT page_id, CAST(pos AS BIGINT) AS pos, url, {strip} AS text,
  CASE WHEN {lhost} = '' OR {lhost} = site_host THEN 'internal' ELSE 'external' END AS kind
FROM m WHERE NOT (starts_with(url, '#') OR starts_with(url, 'javascript:'))
"""


def links_sql(src: str) -> str:
    return LINKS_SQL.format(host=host_sql("url"), src=src, strip=strip_sql("raw"), lhost=host_sql("url"))


@query("extract_links", oracle=links_sql("pages"))
def extract_links(t):
    """Link rows (page, pos, url, text, internal/external) of every page."""
    return X.page_links(t.pages)


@query("extract_links_enriched", oracle=links_sql("enriched_pages"), views=("enriched_pages",))
def extract_links_enriched(t):
    """Links over pages with absolute, protocol-relative, mailto and #anchor links."""
    return X.page_links(t.enriched_pages)


@query("link_counts", oracle=f"""
WITH l AS ({links_sql('enriched_pages')})
SELECT p.page_id,
  CAST(count(*) FILTER (WHERE l.kind = 'internal') AS BIGINT) AS internal_count,
  CAST(count(*) FILTER (WHERE l.kind = 'external') AS BIGINT) AS external_count
FROM enriched_pages p LEFT JOIN l ON p.page_id = l.page_id GROUP BY p.page_id
""", views=("enriched_pages",))
def link_counts(t):
    """internal_count / external_count per page (row-local array filters)."""
    return X.link_counts(t.enriched_pages)


@query("extract_images", oracle="""
WITH m AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?i)<img[^>]+>')) AS tag,
    generate_subscripts(regexp_extract_all(html, '(?i)<img[^>]+>'), 1) AS pos
  FROM enriched_pages),
a AS (
  SELECT page_id, pos,
    regexp_extract(tag, '(?i)src="([^"]+)"', 1) AS src, regexp_extract(tag, '(?i)alt="([^"]*)"', 1) AS alt,
    regexp_extract(tag, '(?i)width="([^"]+)"', 1) AS width, regexp_extract(tag, '(?i)height="([^"]+)"', 1) AS height,
    regexp_extract(tag, '(?i)loading="([^"]+)"', 1) AS loading
  FROM m)
SELECT page_id, CAST(pos AS BIGINT) AS pos, src, alt, width, height, loading,
  NOT (alt = '' OR alt = '0') AS has_alt, loading = 'lazy' AS has_lazy_loading, 'content' AS source
FROM a
""", views=("enriched_pages",))
def extract_images(t):
    """Image rows (src, alt, size, loading, has_alt, lazy) of every page."""
    return X.page_images(t.enriched_pages)


@query("extract_jsonld", oracle="""
WITH m AS (
  SELECT page_id,
    unnest(regexp_extract_all(html, '(?is)<script[^>]+type=["'']application/ld\\+json["''][^>]*>(.*?)</script>', 1)) AS raw,
    generate_subscripts(regexp_extract_all(html, '(?is)<script[^>]+type=["'']application/ld\\+json["''][^>]*>(.*?)</script>', 1), 1) AS pos
  FROM enriched_pages),
j AS (SELECT page_id, pos, trim(raw, chr(32) || chr(9) || chr(10) || chr(13) || chr(11)) AS json FROM m)
SELECT page_id, CAST(pos AS BIGINT) AS pos, json, json_extract_string(json, '$."@type"') AS schema_type
FROM j WHERE json_valid(json) AND json(json)::VARCHAR NOT IN ('{}', '[]', 'false', '0', '0.0', '""', '"0"', 'null')
""", views=("enriched_pages",))
def extract_jsonld(t):
    """JSON-LD scripts of every page that decode to a non-empty value."""
    return X.page_jsonld(t.enriched_pages)


@query("section_markers", oracle="""
SELECT page_id, 'HERO' AS marker FROM enriched_pages
WHERE regexp_matches(html, '(?s)<!-- ECHO5:START HERO -->.*?<!-- ECHO5:END HERO -->')
""", views=("enriched_pages",))
def section_markers(t):
    """Marked section names per page (START/END pairs with the same name)."""
    return (t.enriched_pages.select("page_id", F.explode(H.section_markers(F.col("html"))).alias("marker")))


@query("union_pages_posts", oracle="""
SELECT CAST(id AS BIGINT) AS id, post_type FROM posts WHERE post_type = 'page' AND post_status = 'publish'
UNION ALL
SELECT CAST(id AS BIGINT) AS id, post_type FROM posts WHERE post_type = 'post' AND post_status = 'publish'
""", views=("posts",))
def union_pages_posts(t):
    """Published pages followed by published posts."""
    pages = X.load_pages(t.posts, ("page",)).select(F.col("id").cast("bigint").alias("id"), "post_type")
    posts = X.load_pages(t.posts, ("post",)).select(F.col("id").cast("bigint").alias("id"), "post_type")
    return X.union_pages_posts(pages, posts)


@query("pages_paged", oracle=f"""
SELECT m.* FROM ({MINIMAL_SQL}) m JOIN posts p ON m.id = p.id
WHERE p.post_type = 'page' AND p.post_status = 'publish'
ORDER BY p.menu_order, m.id LIMIT 20 OFFSET 20
""", views=("posts",))
def pages_paged(t):
    """Page 2 of published pages by menu_order (20 per page)."""
    pages = X.load_pages(t.posts, ("page",))
    return X.page_minimal(X.paged(pages, [F.col("menu_order")], per_page=20, page=2))


@query("posts_paged", oracle=f"""
SELECT m.* FROM ({MINIMAL_SQL}) m JOIN posts p ON m.id = p.id
WHERE p.post_type = 'post' AND p.post_status = 'publish'
ORDER BY p.post_date DESC, m.id LIMIT 20
""", views=("posts",))
def posts_paged(t):
    """Page 1 of published posts, newest first (20 per page)."""
    posts = X.load_pages(t.posts, ("post",))
    return X.page_minimal(X.paged(posts, [F.col("post_date").desc()], per_page=20, page=1))


@query("content_all_paged", oracle=f"""
SELECT m.* FROM ({MINIMAL_SQL}) m JOIN posts p ON m.id = p.id
WHERE p.post_type IN ('page', 'post') AND p.post_status = 'publish'
ORDER BY p.post_modified DESC, m.id LIMIT 50
""", views=("posts",))
def content_all_paged(t):
    """Main export listing: pages+posts by modified date, 50 per page."""
    rows = X.load_pages(t.posts)
    return X.page_minimal(X.paged(rows, [F.col("post_modified").desc()], per_page=50, page=1))


@query("pagination_totals", oracle="""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages
FROM posts WHERE post_type = 'page' AND post_status = 'publish'
""", views=("posts",))
def pagination_totals(t):
    """Total published pages and page count at 20 per page."""
    return X.pagination_totals(X.load_pages(t.posts, ("page",)), per_page=20)


@query("internal_links_map", oracle="""
SELECT CAST(count(*) AS BIGINT) AS total_pages,
  'Full internal linking graph requires additional processing' AS note
FROM posts WHERE post_type IN ('page', 'post') AND post_status = 'publish'
""", views=("posts",))
def internal_links_map(t):
    """The published content count and the note that goes with it."""
    return X.internal_links_map(X.load_pages(t.posts))


@query("boilerplate_filter", oracle="""
SELECT doc_id, regexp_matches(lower(text),
  'hours of operation|our location|connect with us|our regular schedule|find us on the map|contact us|navigation|menu|copyright|all rights reserved|privacy policy|terms of service|follow us'
) AS is_boilerplate FROM documents
""")
def boilerplate_filter(t):
    """Whether each document contains one of the 13 boilerplate phrases."""
    return t.documents.select("doc_id", T.is_boilerplate(F.col("text")).alias("is_boilerplate"))


@query("export_record", oracle=f"""
WITH w AS (
  SELECT *, {path_sql('url')} AS path, {strip_sql('post_content')} AS txt,
    list_filter(string_split_regex({strip_sql('post_content')}, '[\\n\\r\\t ]+'), lambda x: x <> '') AS ws
  FROM posts WHERE post_type IN ('page', 'post') AND post_status = 'publish'),
l AS ({links_sql("(SELECT id AS page_id, url, post_content AS html FROM posts WHERE post_type IN ('page', 'post') AND post_status = 'publish')")})
SELECT CAST(w.id AS BIGINT) AS id, post_type AS type, url,
  CASE WHEN path IN ('/', '') THEN '__root__' ELSE ltrim(path, '/') END AS slug, path,
  post_title AS title, post_status AS status,
  CAST(post_date AS TIMESTAMP) AS published_date, CAST(post_modified AS TIMESTAMP) AS modified_date,
  {wc_sql('txt')} AS word_count, CAST(ceil({wc_sql('txt')} / 200) AS BIGINT) AS reading_time,
  CASE WHEN post_excerpt IS NOT NULL AND post_excerpt <> '' THEN post_excerpt
       ELSE array_to_string(list_slice(ws, 1, 30), ' ') || CASE WHEN len(ws) > 30 THEN '&hellip;' ELSE '' END END AS excerpt,
  contains(post_content, '<!-- wp:') AS has_blocks,
  CAST(len(regexp_extract_all(post_content, '(?is)<h1[^>]*>(.*?)</h1>', 1)) AS BIGINT) AS h1_count,
  CAST((SELECT count(*) FROM l WHERE l.page_id = w.id AND l.kind = 'internal') AS BIGINT) AS internal_count,
  CAST((SELECT count(*) FROM l WHERE l.page_id = w.id AND l.kind = 'external') AS BIGINT) AS external_count,
  {blen('post_content')} AS html_length,
  CAST(len(regexp_extract_all(post_content, '(?i)<h[1-6]')) AS BIGINT) AS heading_count
FROM w""", views=("posts",))
def export_record(t):
    """Flagship export record of published pages/posts in one narrow projection (no shuffle)."""
    return X.export_record(t.posts)
