"""Site joins: slug lookup, parents, authors, terms, categories, menus.

Every lookup is set-at-a-time: a batch of requests is joined to the posts
table once (equi-join on the key, shuffle on the key), instead of one query
per request. Small dimensions (users, terms) are left to the optimizer: AQE
turns the join into a broadcast when the measured side is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.operators.export import EDITABLE

# Slug lookup searches pages, then posts, then any other type.
TYPE_PRIORITY = {"page": 1, "post": 2}


def find_by_slug(requests: DataFrame, posts: DataFrame, slug_col: str = "slug",
                 statuses=EDITABLE) -> DataFrame:
    """Match each request slug to one post: page > post > any, newest first.

    Output: request columns + ``post_id`` (NULL when no post has the slug).
    """
    cand = (posts.filter(F.col("post_status").isin(*statuses))
            .select(F.col("post_name").alias("_slug"), F.col("id").alias("post_id"), "post_type", "post_date"))
    prio = F.coalesce(*[F.when(F.col("post_type") == t, F.lit(p)) for t, p in TYPE_PRIORITY.items()], F.lit(3))
    # One winner per slug first (aggregate, no window over the request side),
    # then a join of requests to the winners.
    best = (cand.groupBy("_slug")
            .agg(F.min_by("post_id", F.struct(prio.alias("p"),
                                              (-F.unix_micros(F.col("post_date").cast("timestamp"))).alias("d"),
                                              F.col("post_id").alias("i"))).alias("post_id")))
    return requests.join(best, requests[slug_col] == best["_slug"], "left").drop("_slug")


def parent_lookup(requests: DataFrame, posts: DataFrame, parent_col: str = "parent_slug") -> DataFrame:
    """parent slug -> parent post id through ``find_by_slug``, 0 when absent or unset."""
    found = find_by_slug(requests.select("request_id", parent_col), posts, parent_col)
    return (requests.join(found.select("request_id", F.col("post_id").alias("_pid")), "request_id", "left")
            .withColumn("post_parent", F.coalesce(F.col("_pid"), F.lit(0)).cast("bigint")).drop("_pid"))


def join_author(posts: DataFrame, users: DataFrame) -> DataFrame:
    """author id, display name and email per post (left join; missing user -> NULLs)."""
    u = users.select(F.col("id").alias("post_author"), F.col("display_name").alias("author_name"),
                     F.col("email").alias("author_email"))
    return posts.join(u, "post_author", "left")


def author_match(requests: DataFrame, users: DataFrame, name_col: str = "author_name") -> DataFrame:
    """First user (by login) whose display name, login or nicename equals the name.

    The search has no wildcard, so it is a case-insensitive equality on any of
    the three columns; an empty name or no match gives author id 0.
    Equi-join per column, unioned, then min per request: no theta join.
    """
    cols = ["display_name", "login", "nicename"] if "nicename" in users.columns else ["display_name", "login"]
    keys = None
    for c in cols:
        k = users.select(F.lower(F.col(c)).alias("_k"), F.col("id").alias("_uid"), F.col("login").alias("_login"))
        keys = k if keys is None else keys.unionByName(k)
    best = keys.groupBy("_k").agg(F.min_by("_uid", F.struct("_login", "_uid")).alias("_uid"))
    req = requests.withColumn("_k", F.when(F.col(name_col) != "", F.lower(F.col(name_col))))
    return (req.join(best, "_k", "left")
            .withColumn("post_author", F.coalesce(F.col("_uid"), F.lit(0)).cast("bigint")).drop("_k", "_uid"))


PUBLISHER_LOGIN = "echo5-seo"
PUBLISHER_DISPLAY = "Echo5-Seo"


def publisher_author(users: DataFrame) -> DataFrame:
    """Author for published pages: ``PUBLISHER_LOGIN`` -> ``PUBLISHER_DISPLAY`` name -> first admin -> 1.

    One aggregation over the users table (account creation is not modelled).
    """
    is_admin = F.col("role") == "administrator" if "role" in users.columns else F.lit(False)
    agg = users.agg(
        F.min(F.when(F.lower(F.col("login")) == PUBLISHER_LOGIN, F.col("id"))).alias("by_login"),
        F.min_by("id", F.when(F.lower(F.col("display_name")) == PUBLISHER_DISPLAY.lower(),
                              F.col("login"))).alias("by_name"),
        F.min_by("id", F.when(is_admin, F.col("login"))).alias("by_admin"),
    )
    return agg.select(F.coalesce("by_login", "by_name", "by_admin", F.lit(1)).cast("bigint").alias("author_id"))


def join_terms(posts: DataFrame, relationships: DataFrame, terms: DataFrame) -> DataFrame:
    """Category and tag rows (post, taxonomy, term) for posts of type ``post``."""
    p = posts.filter(F.col("post_type") == "post").select(F.col("id").alias("post_id"))
    return (p.join(relationships, "post_id").join(terms, "term_id")
            .select(F.col("post_id").cast("bigint").alias("post_id"), "taxonomy",
                    F.col("term_id").cast("bigint").alias("term_id"), "name", "slug"))


def category_resolve(requests: DataFrame, terms: DataFrame, slug_col: str = "category_slug") -> DataFrame:
    """Category slug -> term id (NULL keeps the post in the default category)."""
    cats = (terms.filter(F.col("taxonomy") == "category")
            .groupBy(F.col("slug").alias("_s")).agg(F.min("term_id").alias("category_id")))
    return requests.join(cats, requests[slug_col] == cats["_s"], "left").drop("_s")


def slug_exists(requests: DataFrame, posts: DataFrame, slug_col: str = "slug") -> DataFrame:
    """Whether a post of type ``post`` has the requested slug (any status)."""
    names = posts.filter(F.col("post_type") == "post").select(F.col("post_name").alias("_s")).distinct()
    return (requests.join(names.withColumn("exists", F.lit(True)), requests[slug_col] == F.col("_s"), "left")
            .withColumn("exists", F.coalesce("exists", F.lit(False))).drop("_s"))


def menu_structure(items: DataFrame) -> DataFrame:
    """Menu -> items (menu, position, id, title, url, parent_id, order), numbered from 1 by (order, id).

    A position is the number of items with a smaller order plus the rank among those of the
    same order, so only a menu's distinct orders are sorted in one task, never all its items.
    """
    before = Window.partitionBy("menu").orderBy("menu_order").rowsBetween(Window.unboundedPreceding, -1)
    orders = (items.groupBy("menu", "menu_order").agg(F.count(F.lit(1)).alias("_n"))
              .select("menu", "menu_order", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    rank = F.row_number().over(Window.partitionBy("menu", "menu_order").orderBy("id"))
    return (items.join(orders, ["menu", "menu_order"])
            .select("menu", (F.col("_before") + rank).cast("bigint").alias("position"), "id", "title", "url", "parent_id",
                    F.col("menu_order").alias("order")))


def version_count(versions: DataFrame) -> DataFrame:
    """Snapshots stored per page."""
    return versions.groupBy("page_id").agg(F.count(F.lit(1)).cast("bigint").alias("version_count"))


def page_lookup_record(requests: DataFrame, posts: DataFrame, postmeta_wide: DataFrame,
                       versions: DataFrame) -> DataFrame:
    """Slug lookup result: id, title, slug, url, status, modified, managed, last_sync, version_count."""
    found = find_by_slug(requests, posts).filter(F.col("post_id").isNotNull())
    p = posts.select(F.col("id").alias("post_id"), "post_title", "post_name", "url", "post_status", "post_modified")
    vc = version_count(versions).withColumnRenamed("page_id", "post_id")
    managed: Column = F.col("_echo5_managed")
    return (found.join(p, "post_id").join(postmeta_wide, "post_id", "left").join(vc, "post_id", "left")
            .select("request_id", F.col("post_id").cast("bigint").alias("id"),
                    F.col("post_title").alias("title"), F.col("post_name").alias("slug"), "url",
                    F.col("post_status").alias("status"), F.col("post_modified").alias("modified"),
                    (managed.isNotNull() & ~managed.isin("", "0")).alias("echo5_managed"),
                    F.coalesce(F.col("_echo5_last_sync"), F.lit("")).alias("last_sync"),
                    F.coalesce(F.col("version_count"), F.lit(0)).cast("bigint").alias("version_count")))
