"""Batch publish pipeline: request parsing, content rewriting, validation,
upserts of posts and meta, and the composed publish job.

Content rewriting is row-local Column code. Marked-section replacement uses
``split`` + ``array_join`` so replacement text is literal (no ``$1``
interpretation) and every occurrence is replaced. The batch publish is a few
joins (request -> existing post by slug, parent slug, author) and one
projection; conflicts inside a batch resolve to the last request per slug.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.common import byte_len, col, falsy
from pagelens.functions.html import MARKER_RE, content_stats
from pagelens.functions.text import TAG_RE, word_count

# Request defaults from the endpoint's argument schema.
DEFAULT_STATUS = "draft"
DEFAULT_UPDATE_MODE = "safe"
WRAP_MARKER = "echo5-tailwind-content"

# Fixed value: the style wrapper put around published html (exact markup).
WRAP_PREFIX = '''
<!-- Echo5 Tailwind CSS -->
<script src="https://cdn.tailwindcss.com"></script>
<script>
tailwind.config = {
    prefix: "",
    important: ".echo5-tailwind-content",
    corePlugins: {
        preflight: false, // Disable base reset to avoid conflicts with WordPress
    },
    theme: {
        extend: {
            colors: {
                primary: "#3b82f6",
                secondary: "#64748b",
            }
        }
    }
}
</script>
<style>
.echo5-tailwind-content {
    font-family: ui-sans-serif, system-ui, -apple-system, BlinkMacSystemFont, "Segoe UI", Roboto, "Helvetica Neue", Arial, sans-serif;
    line-height: 1.6;
}
.echo5-tailwind-content * {
    box-sizing: border-box;
}
.echo5-tailwind-content h1,
.echo5-tailwind-content h2,
.echo5-tailwind-content h3,
.echo5-tailwind-content h4,
.echo5-tailwind-content h5,
.echo5-tailwind-content h6 {
    font-weight: 700;
    line-height: 1.25;
    margin-bottom: 0.5em;
}
.echo5-tailwind-content h1 { font-size: 2.25rem; }
.echo5-tailwind-content h2 { font-size: 1.875rem; }
.echo5-tailwind-content h3 { font-size: 1.5rem; }
.echo5-tailwind-content p { margin-bottom: 1rem; }
.echo5-tailwind-content ul, .echo5-tailwind-content ol { margin-bottom: 1rem; padding-left: 1.5rem; }
.echo5-tailwind-content li { margin-bottom: 0.25rem; }
.echo5-tailwind-content a { color: #3b82f6; text-decoration: underline; }
.echo5-tailwind-content a:hover { color: #2563eb; }
.echo5-tailwind-content img { max-width: 100%; height: auto; }
.echo5-tailwind-content .bg-gradient-to-r { background-image: linear-gradient(to right, var(--tw-gradient-stops)); }
.echo5-tailwind-content .bg-gradient-to-br { background-image: linear-gradient(to bottom right, var(--tw-gradient-stops)); }
</style>
<!-- End Echo5 Tailwind CSS -->
'''
WRAP_OPEN = '\n<div class="echo5-tailwind-content">\n'
WRAP_CLOSE = '\n</div>'

REQUEST_SCHEMA = (
    "page struct<title:string, slug:string, status:string, parent_slug:string, template:string, "
    "update_mode:string>, content struct<html:string>, "
    "seo struct<meta_title:string, meta_description:string, focus_keyword:string, secondary_keywords:array<string>>, "
    "images struct<featured_image_url:string, gallery_images:array<struct<url:string, alt:string, caption:string>>>, "
    "schema map<string,string>, options struct<idempotency_key:string, skip_validation:boolean, "
    "notify_on_complete:boolean>"
)


def read_publish_requests(raw: DataFrame, json_col: str = "payload") -> DataFrame:
    """Parse JSON publish payloads into typed columns with the endpoint defaults.

    status defaults to 'draft', update_mode to 'safe', skip_validation and
    notify_on_complete to false. Malformed payloads give NULL fields (PERMISSIVE).
    """
    p = F.from_json(F.col(json_col), REQUEST_SCHEMA, {"mode": "PERMISSIVE"})
    return raw.select(
        "*",
        p["page"]["title"].alias("title"), p["page"]["slug"].alias("slug"),
        F.coalesce(p["page"]["status"], F.lit(DEFAULT_STATUS)).alias("status"),
        p["page"]["parent_slug"].alias("parent_slug"), p["page"]["template"].alias("template"),
        F.coalesce(p["page"]["update_mode"], F.lit(DEFAULT_UPDATE_MODE)).alias("update_mode"),
        p["content"]["html"].alias("html"),
        p["seo"]["meta_title"].alias("meta_title"), p["seo"]["meta_description"].alias("meta_description"),
        p["seo"]["focus_keyword"].alias("focus_keyword"),
        p["schema"].alias("schema"),
        p["options"]["idempotency_key"].alias("idempotency_key"),
        F.coalesce(p["options"]["skip_validation"], F.lit(False)).alias("skip_validation"),
        F.coalesce(p["options"]["notify_on_complete"], F.lit(False)).alias("notify_on_complete"),
    )


def _section_re(name: Column) -> Column:
    return F.concat(F.lit("(?s)<!-- ECHO5:START "), name, F.lit(" -->.*?<!-- ECHO5:END "), name, F.lit(" -->"))


def replace_all_literal(s: Column, pattern: Column, replacement: Column) -> Column:
    """Replace every match of ``pattern`` by ``replacement`` taken literally."""
    return F.call_function("array_join", F.split(s, pattern), replacement)


def safe_update(existing, new) -> Column:
    """Merge marked sections of ``new`` into ``existing``; no markers -> ``new`` whole.

    Per section (in order): replace every same-named section of the page;
    else insert it before every ``</body>``; else append after a newline.
    """
    old, nw = col(existing), col(new)
    secs = marked_sections(nw)
    return F.when(F.size(secs) == 0, nw).otherwise(fold_sections(old, secs))


def marked_sections(html) -> Column:
    """The marked sections of a html text, in order: array of (sec, name)."""
    full = F.regexp_extract_all(col(html), F.lit(MARKER_RE), 0)
    names = F.regexp_extract_all(col(html), F.lit(MARKER_RE), 1)
    return F.arrays_zip(full.alias("sec"), names.alias("name"))


def fold_sections(old, secs) -> Column:
    """The text after each section in turn has replaced its namesakes, or been inserted or appended."""
    def step(acc, s):
        pat = _section_re(s["name"])
        present = F.size(F.split(acc, pat)) > 1
        body = F.contains(acc, F.lit("</body>"))
        return (F.when(present, replace_all_literal(acc, pat, s["sec"]))
                .when(body, F.replace(acc, F.lit("</body>"), F.concat(s["sec"], F.lit("\n</body>"))))
                .otherwise(F.concat(acc, F.lit("\n"), s["sec"])))

    return F.aggregate(col(secs), col(old), step)


def batch_updates(requests: DataFrame, order: str = "requested_at", by: tuple[str, ...] = ("slug",)) -> DataFrame:
    """Per slug (or other columns ``by``) what a batch of requests amounts to: the last request's fields, ``base_html`` and ``sections``.

    ``base_html`` is the html of the last request that replaces the whole page (no marked
    section, or another mode than ``safe``), NULL if there is none; ``first_html`` and ``first_request`` are those of the first
    request. ``sections`` holds, of every section named since then, the newest text, in the order in
    which the names first came: folding these gives what folding every request in turn gives. Only
    aggregates by slug and by (slug, section): no window over html, no gathering of requests.
    """
    at = F.struct(order, "request_id")
    by = list(by)
    r = requests.withColumns({"_at": at, "_secs": marked_sections("html")})
    whole = (F.col("update_mode") != "safe") | (F.size("_secs") == 0)
    fields = [c for c in requests.columns if c not in (*by, "html")]
    last = r.groupBy(*by).agg(
        F.max_by(F.struct(*fields), F.col("_at")).alias("_r"), F.max(F.when(whole, F.col("_at"))).alias("_full_at"),
        F.max_by("html", F.when(whole, F.col("_at"))).alias("base_html"), F.min_by("html", F.col("_at")).alias("first_html"),
        F.min("_at")["request_id"].alias("first_request"))
    rows = r.filter(~whole).select(*by, "_at", F.posexplode("_secs").alias("_i", "_s"))
    rows = rows.join(last.select(*by, "_full_at"), by).filter(F.col("_full_at").isNull() | (F.col("_at") > F.col("_full_at")))
    place = F.struct("_at", "_i")
    newest = rows.groupBy(*by, F.col("_s.name").alias("_name")).agg(F.max_by("_s.sec", place).alias("sec"), F.min(place).alias("_first"))
    per_slug = newest.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_first", "sec", F.col("_name").alias("name")))).alias("_secs"))
    none = F.expr("cast(array() as array<struct<sec:string,name:string>>)")
    return (last.join(per_slug, by, "left")
            .select(*by, "_r.*", "base_html", "first_html", "first_request", F.coalesce(
                F.transform("_secs", lambda x: F.struct(x["sec"].alias("sec"), x["name"].alias("name"))), none).alias("sections")))


def wrap_content(html) -> Column:
    """Add the style wrapper unless the html already carries its marker class."""
    h = col(html)
    return F.when(F.contains(h, F.lit(WRAP_MARKER)), h).otherwise(
        F.concat(F.lit(WRAP_PREFIX), F.lit(WRAP_OPEN), h, F.lit(WRAP_CLOSE)))


SCHEMA_SECTION_RE = "(?s)<!-- ECHO5:START SCHEMA -->.*?<!-- ECHO5:END SCHEMA -->"
GALLERY_SECTION_RE = "(?s)<!-- ECHO5:START GALLERY -->.*?<!-- ECHO5:END GALLERY -->"


def schema_block(schema, unicode: bool = False) -> Column:
    """JSON-LD block for every non-empty schema entry (type -> JSON text), in key order, pretty-printed."""
    from pagelens.functions.pyudf import schema_scripts, schema_scripts_unicode

    m = F.map_filter(col(schema), lambda k, v: ~(falsy(v) | v.isin("null", "{}", "[]", "false")))
    # only maps with something to print reach the Arrow-batched UDF
    printed = schema_scripts_unicode if unicode else schema_scripts
    scripts = F.coalesce(printed(F.when(F.size(m) > 0, m)), F.lit(""))
    return F.concat(F.lit("\n<!-- ECHO5:START SCHEMA -->\n"), scripts, F.lit("<!-- ECHO5:END SCHEMA -->\n"))


def inject_schema(content, schema) -> Column:
    """Replace the SCHEMA section (every occurrence) or append it; no-op for empty schema."""
    c, block = col(content), schema_block(schema)
    has = F.size(F.split(c, SCHEMA_SECTION_RE)) > 1
    out = F.when(has, replace_all_literal(c, F.lit(SCHEMA_SECTION_RE), block)).otherwise(F.concat(c, block))
    return F.when(col(schema).isNull() | (F.size(col(schema)) == 0), c).otherwise(out)


def inject_gallery(content, gallery_html) -> Column:
    """GALLERY section: replace; else before FAQ start; else before SCHEMA start; else append."""
    c = col(content)
    sec = F.concat(F.lit("\n<!-- ECHO5:START GALLERY -->\n"), col(gallery_html), F.lit("\n<!-- ECHO5:END GALLERY -->\n"))
    faq, sch = "<!-- ECHO5:START FAQ -->", "<!-- ECHO5:START SCHEMA -->"
    return (F.when(F.size(F.split(c, GALLERY_SECTION_RE)) > 1, replace_all_literal(c, F.lit(GALLERY_SECTION_RE), sec))
            .when(F.contains(c, F.lit(faq)), F.replace(c, F.lit(faq), F.concat(sec, F.lit("\n" + faq))))
            .when(F.contains(c, F.lit(sch)), F.replace(c, F.lit(sch), F.concat(sec, F.lit("\n" + sch))))
            .otherwise(F.concat(c, sec)))


def html_escape_attr(c) -> Column:
    """esc_attr / esc_html: & < > " ' as entities."""
    c = col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def gallery_html(images, columns: int = 3) -> Column:
    """Grid markup for an array of (id, url, alt, caption) images; entries without id skipped."""
    imgs = F.filter(col(images), lambda i: i["id"].isNotNull() & (i["id"] != 0))

    def fig(i):
        cap = F.when(~falsy(i["caption"]), F.concat(
            F.lit('<figcaption class="p-3 bg-gray-100 text-gray-700 text-sm">'), html_escape_attr(i["caption"]),
            F.lit("</figcaption>"))).otherwise(F.lit(""))
        return F.concat(
            F.lit('<figure class="echo5-gallery-item overflow-hidden rounded-lg shadow-lg">'),
            F.lit('<a href="'), i["url"], F.lit('" class="block" data-lightbox="echo5-gallery">'),
            F.lit('<img src="'), i["url"], F.lit('" alt="'), html_escape_attr(F.coalesce(i["alt"], F.lit(""))),
            F.lit('" loading="lazy" class="w-full h-auto object-cover transition-transform hover:scale-105">'),
            F.lit("</a>"), cap, F.lit("</figure>"))
    body = F.array_join(F.transform(imgs, fig), "")
    head = F.lit(f'<div class="echo5-gallery grid grid-cols-1 md:grid-cols-2 lg:grid-cols-{int(columns)} gap-4">')
    return F.when(F.size(col(images)) == 0, F.lit("")).otherwise(F.concat(head, body, F.lit("</div>")))


def inline_image_markers(content, images, featured_is_first) -> Column:
    """``<!-- image:N -->`` -> figure; the first marker is removed when it is the featured image.

    An image without url (and without base64) leaves its marker in place.
    """
    def step(acc, x):
        marker = F.concat(F.lit("<!-- image:"), (x["i"] + 1).cast("string"), F.lit(" -->"))
        url = F.coalesce(x["img"]["url"], F.lit(""))
        alt = F.coalesce(x["img"]["alt"], F.lit(""))
        fig = F.concat(F.lit('<figure><img src="'), url, F.lit('" alt="'), html_escape_attr(alt), F.lit('" /></figure>'))
        return (F.when(col(featured_is_first) & (x["i"] == 0), F.replace(acc, marker, F.lit("")))
                .when(url != "", F.replace(acc, marker, fig)).otherwise(acc))
    indexed = F.transform(col(images), lambda img, i: F.struct(i.alias("i"), img.alias("img")))
    return F.aggregate(F.coalesce(indexed, F.array().cast("array<struct<i:int,img:struct<url:string,alt:string>>>")),
                       col(content), step)


def seo_score(title, meta_description, html, focus_keyword) -> Column:
    """100 minus penalties for title/description length, words, missing h1/keyword; floor 0."""
    t, d, h = col(title), col(meta_description), col(html)
    tl, dl = byte_len(F.coalesce(t, F.lit(""))), byte_len(F.coalesce(d, F.lit("")))
    words = word_count(F.regexp_replace(F.coalesce(h, F.lit("")), TAG_RE, ""))
    score = (F.lit(100)
             - F.when(tl < 30, 10).otherwise(0) - F.when(tl > 60, 5).otherwise(0)
             - F.when(falsy(d), 15).when(dl < 120, 5).when(dl > 160, 5).otherwise(0)
             - F.when(words < 300, 20).when(words < 500, 10).otherwise(0)
             - F.when(~F.contains(F.coalesce(h, F.lit("")), F.lit("<h1")), 15).otherwise(0)
             - F.when(falsy(col(focus_keyword)), 10).otherwise(0))
    return F.greatest(F.lit(0), score).cast("int")


def validate_page(requests: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Dry-run validation: issues/warnings codes, valid flag, stats, score.

    ``requests``: request_id, slug, title, update_mode, html, meta_description,
    focus_keyword; ``existing``: (slug, post_id) from ``find_by_slug``.
    """
    t, d, h = F.col("title"), F.col("meta_description"), F.col("html")
    tl, dl = byte_len(F.coalesce(t, F.lit(""))), byte_len(F.coalesce(d, F.lit("")))
    issues = F.array_compact(F.array(
        F.when(falsy(t) | (tl < 10), F.lit("title_too_short")),
        F.when(falsy(h) | (byte_len(F.coalesce(h, F.lit(""))) < 500), F.lit("content_too_short"))))
    warnings = F.array_compact(F.array(
        F.when(tl > 60, F.lit("title_too_long")),
        F.when(falsy(d), F.lit("meta_description_missing")),
        F.when(~falsy(d) & (dl < 120), F.lit("meta_description_short")),
        F.when(~falsy(d) & (dl > 160), F.lit("meta_description_long")),
        F.when(~F.contains(F.coalesce(h, F.lit("")), F.lit("<h1")), F.lit("no_h1")),
        F.when((F.col("update_mode") == "safe") & (F.size(F.regexp_extract_all(F.coalesce(h, F.lit("")),
                                                                                 F.lit(MARKER_RE), 0)) == 0),
               F.lit("no_section_markers"))))
    out = requests
    if existing is not None:
        out = out.join(existing.select("request_id", F.col("post_id").alias("existing_page_id")), "request_id", "left")
    else:
        out = out.withColumn("existing_page_id", F.lit(None).cast("bigint"))
    stats = content_stats(F.coalesce(h, F.lit("")))
    return out.select(
        "request_id", (F.size(issues) == 0).alias("valid"),
        F.col("existing_page_id").isNull().alias("would_create"),
        F.col("existing_page_id").isNotNull().alias("would_update"), "existing_page_id",
        F.array_join(issues, ",").alias("issues"), F.array_join(warnings, ",").alias("warnings"),
        seo_score(t, d, h, F.col("focus_keyword")).alias("seo_score"),
        stats["html_length"].alias("html_length"), stats["word_count"].alias("word_count"),
        stats["heading_count"].alias("heading_count"))


def blog_validate(requests: DataFrame) -> DataFrame:
    """Blog payload checks: title and content required; status publish|draft else publish; category 'blog'."""
    st = F.coalesce(F.col("status"), F.lit(""))
    status = F.when(falsy(st), F.lit("publish")).otherwise(st)
    error = (F.when(falsy(F.col("title")), F.lit("title is required"))
             .when(falsy(F.col("content")), F.lit("content is required")))
    cat = F.when(falsy(F.col("category_slug")), F.lit("blog")).otherwise(F.col("category_slug"))
    return requests.select(
        "request_id", error.alias("error"),
        F.when(status.isin("publish", "draft"), status).otherwise(F.lit("publish")).alias("status"),
        cat.alias("category_slug"))


def tailwind_section_style(class_attr) -> Column:
    """Section settings from utility classes: gray background shades and py-N padding (N*4 px)."""
    c = col(class_attr)
    shade = F.regexp_extract(c, r"(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\d+)", 1).try_cast("int")
    bg = (F.when(shade >= 800, F.lit("#1f2937")).when(shade >= 600, F.lit("#4b5563"))
          .when(shade >= 100, F.lit("#f3f4f6")))
    py = F.regexp_extract(c, r"(?i)py-(\d+)", 1).try_cast("int")
    return F.struct(bg.alias("background_color"), (py * 4).cast("string").alias("padding_y"))


def upsert_pages(posts: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """Posts after applying ``updates`` (same columns; NULL = keep old value) and inserts.

    Posts left-joined with the (few) updates, which Spark may broadcast by their measured
    size, and the updates without a post: the posts' html is never shuffled for it.
    """
    cols = [c for c in posts.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_n_{c}") for c in cols if c in updates.columns])
    j = posts.join(u, key, "left")
    kept = j.select(key, *[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in updates.columns else F.col(c) for c in cols])
    new = u.join(posts.select(key), key, "left_anti")
    kinds = dict(posts.dtypes)
    return kept.unionByName(new.select(F.col(key).cast(kinds[key]).alias(key), *[
        (F.col(f"_n_{c}") if c in updates.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in cols]))


def upsert_meta(postmeta: DataFrame, changes: DataFrame) -> DataFrame:
    """(post_id, meta_key) -> value after update-or-insert; existing keys read by first meta_id.

    One scan and one shuffle: changes stand beside the stored rows and win by key.
    Of several changes of one key the greatest value is taken, so they never multiply rows.
    """
    kind = dict(postmeta.dtypes)["post_id"]
    rows = postmeta.select("post_id", "meta_key", "meta_value", "meta_id", F.lit(False).alias("_new")).unionByName(changes.select(
        F.col("post_id").cast(kind).alias("post_id"), "meta_key", "meta_value", F.lit(None).cast(dict(postmeta.dtypes)["meta_id"]).alias("meta_id"), F.lit(True).alias("_new")))
    new = F.max(F.when(F.col("_new"), F.struct("meta_value")))
    old = F.min_by("meta_value", F.when(~F.col("_new"), F.col("meta_id")))
    rows = rows.groupBy("post_id", "meta_key").agg(new.alias("_n"), old.alias("_o"))
    return rows.select("post_id", "meta_key", F.when(F.col("_n").isNotNull(), F.col("_n.meta_value")).otherwise(F.col("_o")).alias("meta_value"))


def robots_meta(plugin, noindex, nofollow) -> Column:
    """Robots meta writes in the active plugin's format: array of (meta_key, meta_value).

    yoast '1'/'' per flag; aioseo/seopress '1'/'0'; rankmath a list (JSON text);
    otherwise the generic 'index|noindex,follow|nofollow' string.
    """
    p, ni, nf = col(plugin), col(noindex), col(nofollow)

    def kv(k, v):
        return F.struct(F.lit(k).alias("meta_key"), v.alias("meta_value"))
    yoast = F.array(kv("_yoast_wpseo_meta-robots-noindex", F.when(ni, "1").otherwise("")),
                    kv("_yoast_wpseo_meta-robots-nofollow", F.when(nf, "1").otherwise("")))
    rank = F.array(kv("rank_math_robots", F.to_json(F.array_compact(F.array(
        F.when(ni, F.lit("noindex")), F.when(nf, F.lit("nofollow")))))))
    aio = F.array(kv("_aioseo_noindex", F.when(ni, "1").otherwise("0")),
                  kv("_aioseo_nofollow", F.when(nf, "1").otherwise("0")))
    sp = F.array(kv("_seopress_robots_index", F.when(ni, "1").otherwise("0")),
                 kv("_seopress_robots_follow", F.when(nf, "1").otherwise("0")))
    gen = F.array(kv("_echo5_robots", F.concat(F.when(ni, "noindex").otherwise("index"), F.lit(","),
                                              F.when(nf, "nofollow").otherwise("follow"))))
    return (F.when(p == "yoast", yoast).when(p == "rankmath", rank).when(p == "aioseo", aio)
            .when(p == "seopress", sp).otherwise(gen))


def save_meta_map(requests: DataFrame, active: DataFrame) -> DataFrame:
    """Meta writes of each request by itself as (request_id, post_id, meta_key, meta_value) rows, a key once a request.

    The rules are those of ``replay.seo_ops``, which also tells what a whole batch amounts to; fields that
    ``requests`` lacks count as not given.
    """
    from pagelens.operators.replay import composed, seo_ops

    text = ["og_image", "twitter_title", "twitter_description"]
    lacking = {c: F.lit(None).cast("string") for c in text if c not in requests.columns}
    if "secondary_keywords" not in requests.columns:
        lacking["secondary_keywords"] = F.array().cast("array<string>")
    if "requested_at" not in requests.columns:
        lacking["requested_at"] = F.lit(None).cast("timestamp")
    known = requests.join(active.select(F.col("id").alias("post_id")), "post_id", "left_semi")
    ops = seo_ops(known.withColumns(lacking) if lacking else known, active)
    rows = composed(ops, ["request_id", "post_id", "meta_key"])
    value = F.when(F.col("_added").isNull(), F.col("_set.v")).otherwise(F.concat_ws(",", "_set.v", "_added.all"))
    return rows.select("request_id", "post_id", "meta_key", value.alias("meta_value")).filter(F.col("meta_value").isNotNull())


# SEO update fields in the order they are reported.
SEO_UPDATE_FIELDS = ("meta_title", "meta_description", "focus_keyword", "canonical", "og_title",
                     "og_description", "og_image")


def seo_update_batch(requests: DataFrame, posts: DataFrame, h1_actions: DataFrame | None = None) -> DataFrame:
    """Partial SEO updates by post id: fields provided (non-NULL) are applied and listed.

    ``updates_applied`` = provided SEO fields in order, then page_title, then
    schema. Unknown ids give status ``post_not_found``. With ``h1_actions``
    (from the builder tree) the H1 handling is reported when a page title is set.
    """
    p = posts.select(F.col("id").alias("post_id"), F.col("post_title").alias("old_title"))
    j = requests.join(p, "post_id", "left")
    applied = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in SEO_UPDATE_FIELDS],
                                      F.when(F.col("page_title").isNotNull(), F.lit("page_title")),
                                      F.when(F.col("schema").isNotNull(), F.lit("schema"))))
    found = F.col("old_title").isNotNull()
    out = j.select("request_id", "post_id",
                   F.when(found, F.lit("ok")).otherwise(F.lit("post_not_found")).alias("status"),
                   F.when(found, F.array_join(applied, ",")).alias("updates_applied"),
                   F.when(found, F.coalesce("page_title", "old_title")).alias("post_title"),
                   F.col("page_title").isNotNull().alias("_pt"))
    if h1_actions is not None:
        a = h1_actions.select(F.col("page_id").alias("post_id"), F.col("action").alias("_a"))
        out = out.join(a, "post_id", "left").withColumn(
            "elementor_h1_action", F.when((F.col("status") == "ok") & F.col("_pt"), F.col("_a"))).drop("_a")
    return out.drop("_pt")
