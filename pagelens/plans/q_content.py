"""Remaining §2 queries: export record/sink, link graph, unions, builder text, widgets, SEO update."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.functions import html as H
from pagelens.functions import text as T
from pagelens.functions import url as U
from pagelens.operators import blocks as B
from pagelens.operators import export as X
from pagelens.operators import publish as P
from pagelens.operators import seo as S
from pagelens.operators import site as SI
from pagelens.operators import tree as TR
from pagelens.plans.duck import host_sql, path_sql, strip_sql
from pagelens.plans.q_export import links_sql
from pagelens.plans.registry import REGISTRY, query
from pagelens.sources.fixtures import FIXTURE_SQL


def _sub(key: str, cols: str = "*") -> str:
    """A registered query's oracle as a subquery."""
    return f"(SELECT {cols} FROM ({REGISTRY[key].oracle}) q_{key})"


@query("is_typography_property", oracle=f"SELECT page_id, path, key, is_typography FROM {_sub('is_color_property')}")
def is_typography_property(t):
    """Typography key test on every string setting of every builder node."""
    return REGISTRY["is_color_property"].fn(t).select("page_id", "path", "key", "is_typography")


@query("is_valid_color", oracle=f"SELECT page_id, path, key, value, valid FROM {_sub('normalize_hex')}")
def is_valid_color(t):
    """#RGB / #RRGGBB / rgb( / rgba( test on every colour setting value."""
    return REGISTRY["normalize_hex"].fn(t).select("page_id", "path", "key", "value", "valid")


@query("luminance", oracle=f"SELECT page_id, path, key, h, luminance FROM {_sub('hex_to_rgb')}")
def luminance(t):
    """(0.299 R + 0.587 G + 0.114 B) / 255 of every normalized colour."""
    return REGISTRY["hex_to_rgb"].fn(t).select("page_id", "path", "key", "h", "luminance")


@query("internal_link_graph", oracle=f"""
WITH l AS ({links_sql('pages')}),
src AS (SELECT page_id, {host_sql('url')} AS src_host FROM pages),
e AS (SELECT l.page_id, CASE WHEN {host_sql('l.url')} = '' THEN src.src_host ELSE {host_sql('l.url')} END AS host,
        {path_sql('l.url')} AS path
      FROM l JOIN src ON src.page_id = l.page_id
      WHERE l.kind = 'internal' AND (starts_with(l.url, '/') OR starts_with(lower(l.url), 'http'))),
n AS (SELECT page_id AS dst, {host_sql('url')} AS host, {path_sql('url')} AS path FROM pages),
m AS (SELECT e.page_id, n.dst FROM e JOIN n ON n.host = e.host AND n.path = e.path)
SELECT p.page_id,
  CAST(coalesce((SELECT count(*) FROM e WHERE e.page_id = p.page_id), 0) AS BIGINT) AS out_links,
  CAST(coalesce((SELECT count(*) FROM m WHERE m.page_id = p.page_id), 0) AS BIGINT) AS out_degree,
  CAST(coalesce((SELECT count(*) FROM m WHERE m.dst = p.page_id), 0) AS BIGINT) AS in_degree
FROM pages p""")
def internal_link_graph(t):
    """Internal link graph of all pages: links out, edges to known pages, edges in."""
    return X.internal_link_graph(t.pages)


@query("union_images", oracle=f"""
WITH a AS (SELECT page_id, pos, src, alt, source FROM {_sub('extract_images')}),
b AS (SELECT page_id, pos, src, alt, source FROM {_sub('tree_images')}),
n AS (SELECT page_id, max(pos) AS n FROM a GROUP BY page_id)
SELECT * FROM a UNION ALL
SELECT b.page_id, b.pos + coalesce(n.n, 0), b.src, b.alt, b.source FROM b LEFT JOIN n ON n.page_id = b.page_id""")
def union_images(t):
    """Content images followed by builder images for every page (order and duplicates kept)."""
    a = X.page_images(t.enriched_pages)
    b = TR.tree_images(TR.tree_nodes(t.builder_trees), t.attachments)
    return X.union_images(a, b)


@query("schema_merge", oracle="""
WITH r AS (SELECT request_id, schema_json AS s,
  CASE request_id % 4 WHEN 0 THEN '{"@type":"Organization","name":"N"}' WHEN 1 THEN '{"faqpage":{"q":1},"service":""}' END AS sd
  FROM publish_requests),
e AS (SELECT request_id, je.key, CAST(je.value AS VARCHAR) AS v, 0 AS src FROM r, json_each(r.s) je
  UNION ALL SELECT request_id, 'structured_data', sd, 1 FROM r
    WHERE sd IS NOT NULL AND (json_extract(sd, '$."@graph"') IS NOT NULL OR json_extract(sd, '$."@type"') IS NOT NULL)
  UNION ALL SELECT request_id, je.key, CAST(je.value AS VARCHAR), 1 FROM r, json_each(r.sd) je
    WHERE r.sd IS NOT NULL AND json_extract(r.sd, '$."@graph"') IS NULL AND json_extract(r.sd, '$."@type"') IS NULL),
w AS (SELECT request_id, key, arg_max(v, src) AS v FROM e GROUP BY request_id, key)
SELECT request_id, key AS type, CASE WHEN starts_with(v, '"') THEN json_extract_string(v, '$') ELSE v END AS schema FROM w
WHERE v IS NOT NULL AND v NOT IN ('', '0', 'null', '{}', '[]', 'false', '""', '"0"')""", views=("publish_requests",))
def schema_merge(t):
    """Stored schemas merged with structured data (wrapped when it has @type/@graph; later wins)."""
    r = t.publish_requests.select(
        "request_id", F.from_json("schema_json", "map<string,string>").alias("s"),
        F.when(F.col("request_id") % 4 == 0, F.lit('{"@type":"Organization","name":"N"}'))
        .when(F.col("request_id") % 4 == 1, F.lit('{"faqpage":{"q":1},"service":""}')).alias("sd"))
    m = S.schema_merge(F.col("s"), F.col("sd"))
    return r.select("request_id", F.explode(m).alias("type", "schema"))


@query("content_blocks_smart", oracle=f"""
WITH a AS (SELECT page_id, pos, tag, text, 1 AS src FROM {_sub('content_blocks_main')}),
b AS (SELECT page_id, pos, tag, text, 2 AS src FROM {_sub('tree_blocks')}),
c AS (SELECT page_id, pos, tag, text, 3 AS src FROM {_sub('content_blocks_html')}),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT page_id, pos, tag, text, src FROM u
WHERE src = (SELECT min(src) FROM u u2 WHERE u2.page_id = u.page_id)""")
def content_blocks_smart(t):
    """Per page the first non-empty block source: rendered main -> builder tree -> post content."""
    main = B.content_blocks_main(t.pages)
    tree = TR.tree_blocks(TR.tree_nodes(t.builder_trees))
    frag = B.content_blocks_html(t.posts, id_col="id", html_col="post_content")
    return B.content_blocks_smart(main, tree, frag)


FLAT_TEXT_SQL = """WITH n AS (SELECT f.page_id, CAST(je.key AS INTEGER) AS n, je.value AS node
  FROM flat_builder f, json_each(f.flat_json) je),
v AS (SELECT n.page_id, n.n, fl.f, json_extract(n.node, '$.settings."' || fl.name || '"') AS v
  FROM n, (VALUES (0, 'text'), (1, 'heading'), (2, 'content'), (3, 'description'), (4, 'title'), (5, 'subtitle'),
                  (6, 'btn_text'), (7, 'link_text')) fl(f, name)),
s AS (SELECT page_id, n, f, {strip} AS text FROM v WHERE json_type(v) = 'VARCHAR')
SELECT page_id, string_agg(text, ' ' ORDER BY n, f) AS text FROM s WHERE text IS NOT NULL AND text NOT IN ('', '0')
GROUP BY page_id""".replace("{strip}", strip_sql("json_extract_string(v, '$')"))


@query("flat_builder_text", oracle=FLAT_TEXT_SQL, views=("flat_builder",))
def flat_builder_text(t):
    """Text of flat builder node lists (8 text settings), space-joined per page."""
    return TR.flat_builder_text(t.flat_builder)


def _builder_text(t, nodes):
    module = S.load_postmeta(t.postmeta, ["_et_pb_post_content"]).select(
        F.col("post_id").alias("page_id"), T.strip_tags(F.col("meta_value")).alias("text"))
    return TR.builder_text([TR.tree_text(nodes), module, TR.flat_builder_text(t.flat_builder)])


@query("builder_text", oracle=f"""
WITH a AS (SELECT page_id, text, 0 AS f FROM {_sub('tree_text')}),
b AS (SELECT page_id, text, 2 AS f FROM ({FLAT_TEXT_SQL.replace('flat_builder', 'fb')}) q),
m AS (SELECT post_id AS page_id, {strip_sql("arg_min(meta_value, meta_id)")} AS text, 1 AS f FROM pmeta
  WHERE meta_key = '_et_pb_post_content' GROUP BY post_id)
SELECT page_id, string_agg(text, ' ' ORDER BY f) AS text FROM (SELECT * FROM a UNION ALL SELECT * FROM m UNION ALL SELECT * FROM b)
WHERE text IS NOT NULL AND text NOT IN ('', '0') GROUP BY page_id""".replace(
    "WITH a AS", f"WITH fb AS ({FIXTURE_SQL['flat_builder']}),\npmeta AS ({FIXTURE_SQL['postmeta']}),\na AS"))
def builder_text(t):
    """Builder text per page: tree text, module text kept in meta, flat-builder text; non-empty parts joined by a space."""
    return _builder_text(t, TR.tree_nodes(t.builder_trees))


@query("flat_builder_images", oracle="""
WITH n AS (SELECT f.page_id, CAST(je.key AS INTEGER) AS n, je.value AS node FROM flat_builder f, json_each(f.flat_json) je),
v AS (SELECT n.page_id, n.n, fl.f, json_extract(n.node, '$.settings."' || fl.name || '"') AS v
  FROM n, (VALUES (0, 'photo'), (1, 'bg_image'), (2, 'photo_source'), (3, 'image'), (4, 'poster'), (5, 'ss_photo')) fl(f, name)),
x AS (SELECT *, json_extract_string(v, '$') AS s FROM v WHERE v IS NOT NULL),
num AS (SELECT x.page_id, x.n, x.f, a.source_url AS src, coalesce(a.alt, '') AS alt,
          coalesce(CAST(a.width AS VARCHAR), '') AS width, coalesce(CAST(a.height AS VARCHAR), '') AS height
        FROM x JOIN attachments a ON a.id = TRY_CAST(TRY_CAST(x.s AS DOUBLE) AS BIGINT)
        WHERE regexp_matches(x.s, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$') AND a.source_url NOT IN ('', '0')),
url AS (SELECT page_id, n, f, s AS src, '' AS alt, '' AS width, '' AS height FROM x
        WHERE json_type(v) = 'VARCHAR' AND NOT regexp_matches(s, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
          AND regexp_matches(s, '^[A-Za-z][A-Za-z0-9+.-]*://[^\\s/?#]+[^\\s]*$')),
u AS (SELECT * FROM num UNION ALL SELECT * FROM url)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n, f) AS BIGINT) AS pos, src, alt, width, height,
  alt NOT IN ('', '0') AS has_alt, 'beaver_builder' AS source FROM u""", views=("flat_builder", "attachments"))
def flat_builder_images(t):
    """Images of flat builder nodes (attachment ids or URL strings in 6 image settings)."""
    return TR.flat_builder_images(t.flat_builder, t.attachments)


SEO_REQ = """SELECT doc_id AS request_id, doc_id % 300 AS post_id, TIMESTAMP '2024-05-01 00:00:00' + INTERVAL '1' MINUTE * (doc_id % 700) AS requested_at,
  CASE WHEN doc_id % 2 = 0 THEN concat('Meta ', CAST(doc_id AS STRING)) END AS meta_title,
  CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 11 = 1 THEN concat('Text ', CAST(doc_id AS STRING)) END AS meta_description,
  CASE WHEN doc_id % 5 = 0 THEN 'kw' END AS focus_keyword,
  CASE WHEN doc_id % 13 = 2 THEN concat('https://example.com/', CAST(doc_id AS STRING)) END AS canonical, CASE WHEN doc_id % 7 = 0 THEN 'OG' END AS og_title,
  CASE WHEN doc_id % 14 = 0 THEN concat('About ', CAST(doc_id AS STRING)) END AS og_description, CASE WHEN doc_id % 21 = 0 THEN '/i.png' WHEN doc_id % 9 = 0 THEN '/alone.png' END AS og_image,
  CASE WHEN doc_id % 4 = 1 THEN concat('Page ', CAST(doc_id AS STRING)) END AS page_title,
  CASE WHEN doc_id % 12 = 5 THEN '{"@type":"WebPage","name":"Zürich"}' WHEN doc_id % 12 = 11 THEN '{"a":{"@type":"Service"},"b":{"@type":"FAQPage","n":1}}' END AS schema
FROM documents"""


def seo_requests(t):
    text = SEO_REQ.replace("{", "{{").replace("}", "}}").replace("FROM documents", "FROM {documents}")
    return t.spark.sql(text, documents=t.documents)


@query("seo_update_batch", oracle=f"""
WITH r AS ({SEO_REQ.replace('STRING', 'VARCHAR')}),
h AS ({REGISTRY['tree_set_h1'].oracle})
SELECT r.request_id, r.post_id, CASE WHEN p.id IS NULL THEN 'post_not_found' ELSE 'ok' END AS status,
  CASE WHEN p.id IS NOT NULL THEN array_to_string(list_filter([
    CASE WHEN meta_title IS NOT NULL THEN 'meta_title' END, CASE WHEN meta_description IS NOT NULL THEN 'meta_description' END,
    CASE WHEN focus_keyword IS NOT NULL THEN 'focus_keyword' END, CASE WHEN canonical IS NOT NULL THEN 'canonical' END,
    CASE WHEN og_title IS NOT NULL THEN 'og_title' END, CASE WHEN og_description IS NOT NULL THEN 'og_description' END,
    CASE WHEN og_image IS NOT NULL THEN 'og_image' END, CASE WHEN page_title IS NOT NULL THEN 'page_title' END,
    CASE WHEN schema IS NOT NULL THEN 'schema' END], lambda x: x IS NOT NULL), ',') END AS updates_applied,
  CASE WHEN p.id IS NOT NULL THEN coalesce(page_title, p.post_title) END AS post_title,
  CASE WHEN p.id IS NOT NULL AND page_title IS NOT NULL THEN h.action END AS elementor_h1_action
FROM r LEFT JOIN posts p ON p.id = r.post_id LEFT JOIN h ON h.page_id = r.post_id""",
       views=("posts", "builder_trees"))
def seo_update_batch(t):
    """Partial SEO updates by post id: provided fields applied and listed, H1 handling reported."""
    req = seo_requests(t)
    act = TR.tree_set_h1_action(TR.tree_nodes(t.builder_trees))
    h1 = t.builder_trees.select("page_id").join(act, "page_id", "left").select("page_id", F.coalesce("action", F.lit("created")).alias("action"))
    return P.seo_update_batch(req, t.posts, h1).select(
        "request_id", "post_id", "status", "updates_applied", "post_title", "elementor_h1_action")


SEO_COLS = ("meta_title", "meta_description", "focus_keyword", "canonical_url", "robots", "og_title",
            "og_description", "og_image", "twitter_title", "twitter_description", "twitter_image")


# Columns that the full record takes over from the flat export record.
REC_COLS = ("id", "type", "url", "slug", "path", "title", "status", "published_date", "modified_date", "excerpt", "has_blocks",
            "h1_count", "internal_count", "external_count", "html_length", "heading_count")


def _page_full_sql() -> str:
    from pagelens.plans.duck import wc_sql
    from pagelens.plans.q_export import HEADINGS_SQL
    post_src = "(SELECT id AS page_id, post_content AS html, url FROM posts)"
    levels = ", ".join(f"'\"h{i}\":' || coalesce(to_json(list(text ORDER BY pos) FILTER (WHERE level = 'h{i}')), '[]')" for i in range(1, 7))
    links = links_sql(post_src)
    images = REGISTRY["extract_images"].oracle.replace("FROM enriched_pages)", f"FROM {post_src})")
    half = lambda kind: f"coalesce(to_json(list({{'url': url, 'text': text}} ORDER BY pos) FILTER (WHERE kind = '{kind}')), '[]')"
    wc = wc_sql("trim(concat(content_text, ' ', coalesce(bt.text, '')))")
    return f"""
WITH p AS (SELECT id, post_content AS content_html, {strip_sql('post_content')} AS content_text FROM posts),
hd AS (SELECT page_id, '{{' || concat_ws(',', {levels}) || '}}' AS headings FROM ({HEADINGS_SQL.format(strip=strip_sql("raw"), src=post_src)}) GROUP BY page_id),
lk AS (SELECT page_id, '{{"internal":' || {half('internal')} || ',"external":' || {half('external')} || '}}' AS links FROM ({links}) GROUP BY page_id),
im AS (SELECT page_id, 0 AS g, pos, src, alt, source FROM ({images}) UNION ALL SELECT page_id, 1, pos, src, alt, source FROM {_sub('tree_images')}
  UNION ALL SELECT page_id, 2, pos, src, alt, source FROM {_sub('flat_builder_images')}),
ig AS (SELECT page_id, to_json(list({{'src': src, 'alt': alt, 'source': source}} ORDER BY g, pos)) AS images FROM im GROUP BY page_id),
cb AS (SELECT page_id, to_json(list({{'tag': tag, 'text': text}} ORDER BY pos)) AS content_blocks FROM {_sub('content_blocks_smart')} GROUP BY page_id),
js AS (SELECT page_id, '[' || string_agg(json, ',' ORDER BY pos) || ']' AS schema FROM {_sub('extract_jsonld')} GROUP BY page_id),
bt AS (SELECT page_id, text FROM {_sub('builder_text')}),
fi AS (SELECT pm.post_id, a.source_url FROM (SELECT post_id, TRY_CAST(arg_min(meta_value, meta_id) AS BIGINT) AS aid FROM postmeta
  WHERE meta_key = '_thumbnail_id' GROUP BY post_id) pm JOIN attachments a ON a.id = pm.aid),
tp AS (SELECT post_id, arg_min(meta_value, meta_id) AS template FROM postmeta WHERE meta_key = '_wp_page_template' GROUP BY post_id)
SELECT {", ".join("r." + c for c in REC_COLS)}, p.content_html, p.content_text, {wc} AS word_count,
  CAST(ceil({wc} / 200) AS BIGINT) AS reading_time,
  coalesce(hd.headings, '{{"h1":[],"h2":[],"h3":[],"h4":[],"h5":[],"h6":[]}}') AS headings,
  coalesce(lk.links, '{{"internal":[],"external":[]}}') AS links, coalesce(ig.images, '[]') AS images,
  coalesce(cb.content_blocks, '[]') AS content_blocks, coalesce(js.schema, '[]') AS schema,
  fi.source_url AS featured_image, coalesce(tp.template, '') AS template,
  {", ".join("s." + c for c in SEO_COLS)}, a.author_name, a.author_email, t.categories, t.tags
FROM {_sub('export_record')} r JOIN p ON p.id = r.id
LEFT JOIN hd ON hd.page_id = r.id LEFT JOIN lk ON lk.page_id = r.id LEFT JOIN ig ON ig.page_id = r.id
LEFT JOIN cb ON cb.page_id = r.id LEFT JOIN js ON js.page_id = r.id LEFT JOIN bt ON bt.page_id = r.id
LEFT JOIN fi ON fi.post_id = r.id LEFT JOIN tp ON tp.post_id = r.id
LEFT JOIN {_sub('seo_fallbacks')} s ON s.id = r.id
LEFT JOIN {_sub('join_author')} a ON a.id = r.id
LEFT JOIN (SELECT post_id, string_agg(name, ',' ORDER BY term_id) FILTER (WHERE taxonomy = 'category') AS categories,
             string_agg(name, ',' ORDER BY term_id) FILTER (WHERE taxonomy = 'post_tag') AS tags
           FROM {_sub('join_terms')} GROUP BY post_id) t ON t.post_id = r.id"""


def _json_list(rows, order, fields, name, keep=None):
    """Per page the rows as one JSON text, in order."""
    st = F.struct(*order, F.struct(*fields).alias("_v"))
    return rows.groupBy(F.col("page_id").cast("bigint").alias("id")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(st)), lambda x: x["_v"]), {"ignoreNullFields": "false"}).alias(name))


def full_records(t):
    """The full export record per published post, flattened; nested parts are JSON text.

    Row-local parts (content, headings, links) are columns of one projection over
    posts; the rest is joined on the post id from per-page aggregates.
    """
    posts = X.load_pages(t.posts)
    content = F.col("post_content")
    links = F.col("_links")
    kind = lambda k: F.transform(F.filter(links, lambda x: x["kind"] == k), lambda x: F.struct(x["url"].alias("url"), x["text"].alias("text")))
    base = posts.withColumn("_links", H.links(content, U.url_host(F.col("url")))).select(
        F.col("id").cast("bigint").alias("id"), content.alias("content_html"), T.strip_tags(content).alias("content_text"),
        F.to_json(H.heading_map(content)).alias("headings"),
        F.to_json(F.struct(kind("internal").alias("internal"), kind("external").alias("external"))).alias("links"))
    rec = X.export_record(t.posts).select(*REC_COLS)
    nodes = TR.tree_nodes(t.builder_trees)
    text = _builder_text(t, nodes)
    images = X.page_images(posts, "id", "post_content").select(F.lit(0).alias("_g"), "page_id", "pos", "src", "alt", "source")
    for g, more in enumerate((TR.tree_images(nodes, t.attachments), TR.flat_builder_images(t.flat_builder, t.attachments)), 1):
        images = images.unionByName(more.select(F.lit(g).alias("_g"), "page_id", "pos", "src", "alt", "source"))
    blocks = B.content_blocks_smart(B.content_blocks_main(t.pages), TR.tree_blocks(nodes),
                                    B.content_blocks_html(posts, id_col="id", html_col="post_content"))
    ld = X.page_jsonld(t.enriched_pages).groupBy(F.col("page_id").cast("bigint").alias("id")).agg(F.concat(
        F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "json"))), lambda x: x["json"]), ","), F.lit("]")).alias("schema"))
    template = S.load_postmeta(t.postmeta, ["_wp_page_template"]).select(F.col("post_id").cast("bigint").alias("id"), F.col("meta_value").alias("template"))
    featured = S.featured_images(t.postmeta, t.attachments).select(F.col("post_id").cast("bigint").alias("id"), "featured_image")

    seo = S.seo_resolve(t.posts, t.postmeta, t.site_plugins)
    exc = posts.select(F.col("id").cast("bigint").alias("id"),
                       T.excerpt(F.col("post_excerpt"), F.col("post_content")).alias("excerpt"))
    seo_rec = S.seo_fallbacks(seo, t.posts, exc, S.featured_images(t.postmeta, t.attachments)).select("id", *SEO_COLS)
    author = SI.join_author(posts.select("id", "post_author"), t.users).select(
        F.col("id").cast("bigint").alias("id"), "author_name", "author_email")
    tr = SI.join_terms(posts, t.term_relationships, t.terms)

    def names(tax):
        st = F.when(F.col("taxonomy") == tax, F.struct("term_id", "name"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(st)), lambda x: x["name"]), ",")
    terms = tr.groupBy(F.col("post_id").alias("id")).agg(
        F.when(F.count_if(F.col("taxonomy") == "category") > 0, names("category")).alias("categories"),
        F.when(F.count_if(F.col("taxonomy") == "post_tag") > 0, names("post_tag")).alias("tags"))
    j = rec.join(base, "id")
    for part in (text.select(F.col("page_id").cast("bigint").alias("id"), F.col("text").alias("_builder")),
                 _json_list(images, ("_g", "pos"), ("src", "alt", "source"), "images"),
                 _json_list(blocks, ("pos",), ("tag", "text"), "content_blocks"),
                 ld, template, featured, seo_rec, author, terms):
        j = j.join(part, "id", "left")
    words = T.word_count(F.trim(F.concat("content_text", F.lit(" "), F.coalesce("_builder", F.lit("")))))
    j = j.withColumns({"word_count": words, **{c: F.coalesce(c, F.lit("[]")) for c in ("images", "content_blocks", "schema")},
                       "template": F.coalesce("template", F.lit(""))})
    return j.withColumn("reading_time", T.reading_time(F.col("word_count"))).select(
        *REC_COLS, "content_html", "content_text", "word_count", "reading_time", "headings", "links", "images", "content_blocks",
        "schema", "featured_image", "template", *SEO_COLS, "author_name", "author_email", "categories", "tags")


@query("page_full", oracle=_page_full_sql(), views=("posts", "postmeta", "attachments"))
def page_full(t):
    """Full export record per published post: content, headings, blocks, images, links, seo, schema, author, terms, template."""
    return full_records(t)


@query("write_export_json", oracle=f"""SELECT *, CAST((row_number() OVER (ORDER BY published_date DESC, id) - 1) // 50 + 1 AS BIGINT) AS current_page,
  count(*) OVER () AS total, CAST(ceil(count(*) OVER () / 50.0) AS BIGINT) AS pages, CAST(50 AS BIGINT) AS per_page, 'Example' AS site_name
FROM ({_page_full_sql()})""", views=("posts", "postmeta", "attachments"))
def write_export_json(t):
    """Full records written as numbered pages of envelopes (totals, site info), newest first, and read back record by record."""
    from pagelens.sources.sinks import read_export_json, write_export_json as write
    records = full_records(t)
    out = write(records, [F.col("published_date").desc(), F.col("id")], "page_full", site_info={"name": "Example", "url": "https://example.com", "description": "", "language": "en-US"}, timestamp="2024-05-01 00:00:00")
    pages = read_export_json(t.spark, out, records.schema)
    return pages.select(F.explode("data").alias("r"), "pagination.*", F.col("site_info")["name"].alias("site_name")).select("r.*", "current_page", "total", "pages", "per_page", "site_name")
