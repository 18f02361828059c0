"""Site-join queries: slug lookup, parents, authors, terms, categories, menus."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import seo as S
from pagelens.operators import site as X
from pagelens.plans.registry import query

EDITABLE_SQL = "('publish', 'draft', 'pending', 'private')"
BEST_SQL = f"""best AS (SELECT s, id AS post_id FROM (
  SELECT post_name AS s, id, row_number() OVER (PARTITION BY post_name ORDER BY
    CASE post_type WHEN 'page' THEN 1 WHEN 'post' THEN 2 ELSE 3 END, post_date DESC, id) AS rn
  FROM posts WHERE post_status IN {EDITABLE_SQL}) WHERE rn = 1)"""


@query("find_by_slug", oracle=f"""WITH {BEST_SQL}
SELECT r.request_id, r.slug, best.post_id FROM publish_requests r LEFT JOIN best ON best.s = r.slug
""", views=("posts", "publish_requests"))
def find_by_slug(t):
    """Post for each request slug: page > post > any type, newest first."""
    req = t.publish_requests.select("request_id", "slug")
    return X.find_by_slug(req, t.posts)


@query("parent_lookup", oracle=f"""WITH {BEST_SQL}
SELECT r.request_id, CAST(coalesce(best.post_id, 0) AS BIGINT) AS post_parent
FROM publish_requests r LEFT JOIN best ON best.s = r.parent_slug
""", views=("posts", "publish_requests"))
def parent_lookup(t):
    """Parent page id for each request's parent slug (0 when none)."""
    req = t.publish_requests.select("request_id", "parent_slug")
    return X.parent_lookup(req, t.posts).select("request_id", "post_parent")


@query("join_author", oracle="""
SELECT CAST(p.id AS BIGINT) AS id, p.post_author, u.display_name AS author_name, u.email AS author_email
FROM posts p LEFT JOIN users u ON u.id = p.post_author
""", views=("posts", "users"))
def join_author(t):
    """Author id, name and email of every post."""
    return (X.join_author(t.posts, t.users)
            .select(F.col("id").cast("bigint").alias("id"), "post_author", "author_name", "author_email"))


@query("author_match", oracle="""
WITH k AS (SELECT lower(display_name) AS k, id, login FROM users UNION ALL SELECT lower(login), id, login FROM users),
best AS (SELECT k, arg_min(id, login) AS uid FROM k GROUP BY k)
SELECT r.request_id, CAST(coalesce(best.uid, 0) AS BIGINT) AS post_author
FROM blog_requests r LEFT JOIN best ON r.author_name <> '' AND best.k = lower(r.author_name)
""", views=("blog_requests", "users"))
def author_match(t):
    """Author of each blog request: case-insensitive name match on users, else 0."""
    req = t.blog_requests.select("request_id", "author_name")
    return X.author_match(req, t.users).select("request_id", "post_author")


@query("publisher_author", oracle="""
SELECT CAST(coalesce(min(id) FILTER (WHERE lower(login) = 'echo5-seo'),
                     arg_min(id, login) FILTER (WHERE lower(display_name) = 'echo5-seo'), 1) AS BIGINT) AS author_id
FROM users
""", views=("users",))
def publisher_author(t):
    """Author id used for published pages, resolved over the users table."""
    return X.publisher_author(t.users)


@query("join_terms", oracle="""
SELECT CAST(p.id AS BIGINT) AS post_id, tm.taxonomy, CAST(tm.term_id AS BIGINT) AS term_id, tm.name, tm.slug
FROM posts p JOIN term_relationships r ON r.post_id = p.id JOIN terms tm ON tm.term_id = r.term_id
WHERE p.post_type = 'post'
""", views=("posts", "term_relationships", "terms"))
def join_terms(t):
    """Categories and tags of every post of type post."""
    return X.join_terms(t.posts, t.term_relationships, t.terms)


@query("category_resolve", oracle="""
SELECT r.request_id, c.category_id FROM blog_requests r LEFT JOIN
  (SELECT slug, min(term_id) AS category_id FROM terms WHERE taxonomy = 'category' GROUP BY slug) c
  ON c.slug = CASE WHEN r.category_slug = '' THEN 'blog' ELSE r.category_slug END
""", views=("blog_requests", "terms"))
def category_resolve(t):
    """Category id for each blog request's slug (default 'blog'; NULL keeps the default)."""
    req = t.blog_requests.select(
        "request_id", F.when(F.col("category_slug") == "", F.lit("blog"))
        .otherwise(F.col("category_slug")).alias("category_slug"))
    return X.category_resolve(req, t.terms).select("request_id", "category_id")


@query("slug_exists", oracle="""
SELECT r.request_id, EXISTS (SELECT 1 FROM posts p WHERE p.post_type = 'post' AND p.post_name = r.slug) AS "exists"
FROM blog_requests r
""", views=("blog_requests", "posts"))
def slug_exists(t):
    """Whether each requested blog slug is taken by a post."""
    return X.slug_exists(t.blog_requests.select("request_id", "slug"), t.posts).select("request_id", "exists")


@query("menu_structure", oracle="""
SELECT menu, row_number() OVER (PARTITION BY menu ORDER BY menu_order, id) AS position, id, title, url, parent_id,
  menu_order AS "order" FROM menu_items
""", views=("menu_items",))
def menu_structure(t):
    """Every menu's items, numbered by (order, id)."""
    return X.menu_structure(t.menu_items)


@query("version_count", oracle="""
SELECT page_id, CAST(count(*) AS BIGINT) AS version_count FROM page_versions GROUP BY page_id
""", views=("page_versions",))
def version_count(t):
    """Stored snapshots per page."""
    return X.version_count(t.page_versions)


@query("page_lookup_record", oracle=f"""WITH {BEST_SQL},
vc AS (SELECT page_id, count(*) AS n FROM page_versions GROUP BY page_id),
w AS (SELECT post_id, arg_min(meta_value, meta_id) FILTER (WHERE meta_key = '_echo5_managed') AS m,
        arg_min(meta_value, meta_id) FILTER (WHERE meta_key = '_echo5_last_sync') AS ls FROM postmeta GROUP BY post_id)
SELECT r.request_id, CAST(p.id AS BIGINT) AS id, p.post_title AS title, p.post_name AS slug, p.url,
  p.post_status AS status, p.post_modified AS modified,
  coalesce(w.m IS NOT NULL AND w.m NOT IN ('', '0'), false) AS echo5_managed, coalesce(w.ls, '') AS last_sync,
  CAST(coalesce(vc.n, 0) AS BIGINT) AS version_count
FROM publish_requests r JOIN best ON best.s = r.slug JOIN posts p ON p.id = best.post_id
LEFT JOIN w ON w.post_id = p.id LEFT JOIN vc ON vc.page_id = p.id
""", views=("posts", "publish_requests", "postmeta", "page_versions"))
def page_lookup_record(t):
    """Slug lookup record for each request: page fields, managed flag, last sync, versions."""
    req = t.publish_requests.select("request_id", "slug")
    wide = S.meta_wide(t.postmeta, ["_echo5_managed", "_echo5_last_sync"])
    out = X.page_lookup_record(req, t.posts, wide, t.page_versions)
    return out.withColumn("echo5_managed", F.coalesce("echo5_managed", F.lit(False)))
