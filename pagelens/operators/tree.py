"""Page-builder trees (recursive JSON) -> flat node rows, text, images, blocks.

Spark has no recursive struct type, so a tree is parsed once into a VARIANT
and flattened level by level with higher-order functions inside ONE
projection per round (``LEVELS_PER_ROUND`` levels): no shuffle, no re-reading
of the source per level. Nodes deeper than a round are not dropped: their
children become the roots of another round, until no node has children.
``path`` (ARRAY<INT>, child index per level) sorts nodes in pre-order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.common import falsy
from pagelens.functions.text import normalize_text, strip_tags

LEVELS_PER_ROUND = 8


def _children(node: Column) -> Column:
    return F.coalesce(F.try_variant_get(node, "$.elements", "array<variant>"),
                      F.expr("CAST(array() AS array<variant>)"))


def _next_level(level: Column) -> Column:
    return F.flatten(F.transform(level, lambda s: F.transform(
        _children(s["node"]), lambda c, j: F.struct(F.array_append(s["path"], j).alias("path"), c.alias("node")))))


def tree_nodes(trees: DataFrame, id_col: str = "page_id", json_col: str = "tree_json",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten builder trees: (page_id, path, depth, id, elType, widgetType, settings)."""
    roots = F.transform(F.coalesce(F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", "array<variant>"),
                                   F.expr("CAST(array() AS array<variant>)")),
                        lambda n, i: F.struct(F.array(i.cast("int")).alias("path"), n.alias("node")))
    cur = trees.select(F.col(id_col).alias("page_id"), *keep, roots.alias("l0"))
    out = None
    while True:
        cols = ["l0"]
        for k in range(1, LEVELS_PER_ROUND + 1):
            cur = cur.withColumn(f"l{k}", _next_level(F.col(f"l{k - 1}")))
            cols.append(f"l{k}")
        level_rows = cur.select("page_id", *keep, F.explode(F.concat(*[F.col(c) for c in cols[:-1]])).alias("s"))
        out = level_rows if out is None else out.unionByName(level_rows)
        rest = cur.select("page_id", *keep, F.col(cols[-1]).alias("l0")).filter(F.size("l0") > 0)
        if rest.isEmpty():
            break
        cur = rest
    n = F.col("s.node")
    return out.select(
        "page_id", *keep,
        F.col("s.path").alias("path"),
        (F.size("s.path") - 1).cast("int").alias("depth"),
        F.try_variant_get(n, "$.id", "string").alias("id"),
        F.try_variant_get(n, "$.elType", "string").alias("elType"),
        F.try_variant_get(n, "$.widgetType", "string").alias("widgetType"),
        F.try_variant_get(n, "$.settings", "variant").alias("settings"),
    )


def vkind(v: Column) -> Column:
    """'string', 'object', 'array' or 'other' for a VARIANT value."""
    s = F.schema_of_variant(v)
    return (F.when(s == "STRING", F.lit("string")).when(s.startswith("OBJECT"), F.lit("object"))
            .when(s.startswith("ARRAY"), F.lit("array")).otherwise(F.lit("other")))


def vstring(v: Column) -> Column:
    return F.when(vkind(v) == "string", F.try_variant_get(v, "$", "string"))


def vvalues(v: Column) -> Column:
    """Values of a JSON array or object (object keys in VARIANT order)."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"),
                      F.map_values(F.try_variant_get(v, "$", "map<string,variant>")),
                      F.expr("CAST(array() AS array<variant>)"))


def setting(field: str) -> Column:
    return F.try_variant_get(F.col("settings"), f"$['{field}']", "variant")


# Builder widget settings read as text (reference order).
TREE_TEXT_FIELDS = (
    "title", "title_text", "heading", "text", "description",
    "description_text", "editor", "content", "tab_content",
    "testimonial_content", "quote", "alert_description",
    "inner_text", "prefix", "suffix", "button_text",
    "before_text", "after_text", "highlighted_text",
    "rotating_text", "fallback", "item_description",
    "accordion_tab_content", "tab_title", "tab_icon",
    "list_items", "items", "price", "period",
    "features_list", "feature_text",
)


def _expand(df: DataFrame, keys: list[str], v: str = "v") -> DataFrame:
    """Rows (keys..., i, j, x): a value, its items, and its items' values, in order.

    Two chained explodes over small per-value arrays: one pass, no union.
    """
    lvl1 = F.concat(F.array(F.struct(F.lit(-1).alias("i"), F.col(v).alias("x"))),
                    F.transform(vvalues(F.col(v)), lambda it, i: F.struct(i.alias("i"), it.alias("x"))))
    a = df.select(*keys, F.explode(lvl1).alias("a")).select(*keys, "a.i", F.col("a.x").alias("item"))
    lvl2 = F.concat(F.array(F.struct(F.lit(-1).alias("j"), F.col("item").alias("x"))),
                    F.when(F.col("i") >= 0, F.transform(vvalues(F.col("item")),
                                                        lambda sv, j: F.struct(j.alias("j"), sv.alias("x"))))
                    .otherwise(F.array().cast(f"array<struct<j:int,x:variant>>")))
    return a.select(*keys, "i", F.explode(lvl2).alias("b")).select(*keys, "i", "b.j", "b.x")


def _field_values(nodes: DataFrame, fields) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(i).alias("f"), setting(f).alias("v")) for i, f in enumerate(fields)])
    return (nodes.select("page_id", "path", F.explode(F.filter(arr, lambda x: x["v"].isNotNull())).alias("x"))
            .select("page_id", "path", "x.f", "x.v"))


def tree_text_pieces(nodes: DataFrame) -> DataFrame:
    """Text pieces (page_id, path, f, i, j, text) from every node's text settings.

    A string field gives one piece; an array/object field gives its string
    items and the string values of its array/object items. Pieces that are
    empty before or after tag stripping are dropped.
    """
    rows = _expand(_field_values(nodes, TREE_TEXT_FIELDS), ["page_id", "path", "f"])
    rows = rows.select("page_id", "path", "f", "i", "j", vstring(F.col("x")).alias("raw")).filter(~falsy(F.col("raw")))
    return (rows.select("page_id", "path", "f", "i", "j", strip_tags(F.col("raw")).alias("text"))
            .filter(~falsy(F.col("text"))))


def join_pieces(pieces: DataFrame, keys=("page_id",), order=("path", "f", "i", "j"),
                out: str = "text") -> DataFrame:
    """Join ordered text pieces per key with single spaces."""
    st = F.struct(*[F.col(c) for c in order], F.col("text").alias("_t"))
    return (pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(st)).alias("_p"))
            .select(*keys, F.array_join(F.transform("_p", lambda x: x["_t"]), " ").alias(out)))


def tree_text(nodes: DataFrame) -> DataFrame:
    """Builder text per page: non-empty stripped texts in pre-order, space-joined."""
    return join_pieces(tree_text_pieces(nodes))


# Flat-builder node settings read as text (reference order).
FLAT_TEXT_FIELDS = ("text", "heading", "content", "description", "title", "subtitle", "btn_text", "link_text")


def flat_builder_text(flat: DataFrame, id_col: str = "page_id", json_col: str = "flat_json") -> DataFrame:
    """Text of flat builder data (a list of nodes with settings), space-joined per page."""
    nodes = flat.select(F.col(id_col).alias("page_id"),
                        F.posexplode(F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", "array<variant>"))
                        .alias("n", "node"))
    fields = F.array(*[F.struct(F.lit(i).alias("f"), F.try_variant_get("node", f"$.settings['{f}']", "variant").alias("v"))
                       for i, f in enumerate(FLAT_TEXT_FIELDS)])
    pieces = (nodes.select("page_id", "n", F.explode(fields).alias("x"))
              .select("page_id", "n", "x.f", vstring(F.col("x.v")).alias("raw"))
              .filter(F.col("raw").isNotNull())
              .withColumn("text", strip_tags(F.col("raw"))).filter(~falsy(F.col("text"))))
    return join_pieces(pieces, order=("n", "f"))


def builder_text(parts: list[DataFrame]) -> DataFrame:
    """Tree text + shortcode-builder text + flat text: non-empty parts joined by a space."""
    tagged = None
    for i, p in enumerate(parts):
        q = p.select("page_id", F.lit(i).alias("f"), F.col("text")).filter(~falsy(F.col("text")))
        tagged = q if tagged is None else tagged.unionByName(q)
    return join_pieces(tagged, order=("f",))


# Settings that hold images (reference order).
TREE_IMAGE_FIELDS = (
    "image", "background_image", "image_custom_dimension",
    "wp_gallery", "gallery", "slides", "carousel",
    "testimonial_image", "person_image", "team_member_image",
    "icon_image", "graphic_image", "image_overlay",
)


def _has_url(v: Column) -> Column:
    return (vkind(v).isin("object", "array")) & F.try_variant_get(v, "$.url", "variant").isNotNull()


def tree_image_objects(nodes: DataFrame) -> DataFrame:
    """Image objects (page_id, path, f, i, j, obj) found in image settings.

    An object with ``url`` counts once; otherwise each item of an array/object
    value counts if it has ``url``, and each of the item's own values that has
    ``url``. Then ``_background_image`` with a url. One pass of chained explodes.
    """
    n = len(TREE_IMAGE_FIELDS)
    fv = _field_values(nodes, TREE_IMAGE_FIELDS + ("_background_image",)).withColumn("whole", _has_url(F.col("v")))
    rows = _expand(fv, ["page_id", "path", "f", "whole"])
    keep = F.when(F.col("whole"), (F.col("i") == -1) & (F.col("j") == -1)).otherwise(
        (F.col("f") < n) & (F.col("i") >= 0) & _has_url(F.col("x")))
    return rows.filter(keep).select("page_id", "path", "f", "i", "j", F.col("x").alias("obj"))


def tree_images(nodes: DataFrame, attachments: DataFrame | None = None) -> DataFrame:
    """Builder image rows: src, alt (attachment alt, else the widget's), width, height.

    Objects with an empty url are dropped. The attachment join is an
    equi-join on the image id.
    """
    objs = tree_image_objects(nodes)
    url = F.try_variant_get("obj", "$.url", "string")
    img_id = F.try_variant_get("obj", "$.id", "bigint")
    rows = objs.select("page_id", "path", "f", "i", "j", url.alias("src"), img_id.alias("image_id"),
                       F.try_variant_get("obj", "$.alt", "string").alias("obj_alt")).filter(~falsy(F.col("src")))
    if attachments is not None:
        att = attachments.select(F.col("id").alias("image_id"), F.col("alt").alias("att_alt"),
                                 F.col("width").cast("string").alias("att_w"),
                                 F.col("height").cast("string").alias("att_h"))
        rows = rows.join(att, "image_id", "left")
    else:
        rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in ("att_alt", "att_w", "att_h")])
    has_id = F.col("image_id").isNotNull() & (F.col("image_id") != 0)
    alt0 = F.when(has_id, F.coalesce(F.col("att_alt"), F.lit(""))).otherwise(F.lit(""))
    alt = F.when(falsy(alt0) & F.col("obj_alt").isNotNull(), F.col("obj_alt")).otherwise(alt0)
    w = Window.partitionBy("page_id").orderBy("path", "f", "i", "j")
    return rows.select(
        "page_id", F.row_number().over(w).cast("bigint").alias("pos"), "src", alt.alias("alt"),
        F.when(has_id, F.coalesce(F.col("att_w"), F.lit(""))).otherwise(F.lit("")).alias("width"),
        F.when(has_id, F.coalesce(F.col("att_h"), F.lit(""))).otherwise(F.lit("")).alias("height"),
        F.lit("").alias("loading"), (~falsy(alt)).alias("has_alt"), F.lit(False).alias("has_lazy_loading"),
        F.lit("elementor").alias("source"))


def tree_blocks(nodes: DataFrame, cap: int | None = None) -> DataFrame:
    """Blocks from widgets: heading, icon/image box, call-to-action, simple text widgets.

    Candidates are emitted per widget in the reference's order, then the same
    dedup (first per normalized text) and cap as html blocks. ``text-editor``
    html is parsed with the html block operator and merged in node order.
    """
    wt = F.col("widgetType")

    def cand(order: int, tag: Column, field: str, min_len: int, when: Column) -> Column:
        raw = vstring(setting(field))
        txt = strip_tags(raw)
        ok = when & ~falsy(raw) & ~falsy(txt) & (F.octet_length(txt) >= min_len)
        return F.when(ok, F.struct(F.lit(order).alias("k"), tag.alias("tag"), F.trim(txt).alias("text")))

    hraw = setting("header_size")
    header = F.when(hraw.isNull() | F.is_variant_null(hraw), F.lit("h2")).otherwise(F.lower(vstring(hraw)))
    cands = F.array(
        cand(0, header, "title", 10, wt == "heading"),
        cand(1, F.lit("h3"), "title_text", 5, wt.isin("icon-box", "image-box")),
        cand(2, F.lit("p"), "description_text", 20, wt.isin("icon-box", "image-box")),
        cand(3, F.lit("h3"), "title", 5, wt == "call-to-action"),
        cand(4, F.lit("p"), "description", 20, wt == "call-to-action"),
        cand(5, F.lit("p"), "text", 20, wt == "text"),
        cand(6, F.lit("p"), "description", 20, wt == "text"),
        cand(7, F.lit("p"), "testimonial_content", 20, wt == "testimonial"),
        cand(8, F.lit("p"), "blockquote_content", 20, wt == "blockquote"),
    )
    simple = (nodes.select("page_id", "path", F.explode(F.filter(cands, lambda c: c.isNotNull())).alias("c"))
              .select("page_id", "path", F.col("c.k").alias("k"), F.lit(0).alias("sub"), "c.tag", "c.text"))
    from pagelens.operators import blocks as B
    editors = (nodes.filter(wt == "text-editor")
               .select("page_id", "path", vstring(setting("editor")).alias("html"))
               .filter(~falsy(F.col("html")))
               .withColumn("node_key", F.to_json(F.struct("page_id", "path"))))
    eb = B.block_filters(B.block_rows(B.html_tokens(editors, id_col="node_key", html_col="html")), False)
    eb = (eb.join(editors.select("node_key", F.col("page_id").alias("pid"), "path"),
                  eb["page_id"] == F.col("node_key"))
          .select(F.col("pid").alias("page_id"), "path", F.lit(-1).alias("k"), F.col("pos").alias("sub"),
                  "tag", "text"))
    allb = simple.unionByName(eb)
    w1 = Window.partitionBy("page_id", "norm").orderBy("path", "k", "sub")
    w2 = Window.partitionBy("page_id").orderBy("path", "k", "sub")
    return (allb.withColumn("norm", normalize_text(F.col("text")))
            .withColumn("_r", F.row_number().over(w1)).filter("_r = 1")
            .withColumn("pos", F.row_number().over(w2)).filter(F.lit(True) if cap is None else F.col("pos") <= cap)
            .select("page_id", F.col("pos").cast("int").alias("pos"), "tag", "text"))


# Widget types that need Elementor Pro or Pro Elements.
PRO_WIDGETS = (
    "form", "posts", "portfolio", "slides", "flip-box", "price-table",
    "price-list", "testimonial-carousel", "animated-headline",
    "call-to-action", "media-carousel", "countdown", "share-buttons",
    "blockquote", "login", "hotspot", "reviews", "lottie",
)
WPR_WARNING = ("Page contains Royal Elementor Addons widgets (wpr-*) but the plugin is not active. "
               "These widgets may not render correctly.")
PRO_WARNING = ("Page contains Elementor Pro / Pro Elements widgets but neither plugin is active. "
               "These widgets may not render correctly.")


def widget_compat(nodes: DataFrame, caps: DataFrame) -> DataFrame:
    """Per page: uses wpr-* / pro widgets, and warnings when the addon is inactive.

    ``nodes`` carries ``site_id``; ``caps`` is per-site capability flags.
    """
    wt = F.coalesce(F.col("widgetType"), F.lit(""))
    per_page = (nodes.groupBy("page_id", "site_id")
                .agg(F.bool_or(wt.startswith("wpr-")).alias("has_wpr"),
                     F.bool_or(wt.isin(*PRO_WIDGETS)).alias("has_pro")))
    j = per_page.join(caps.select("site_id", "royal_elements", F.col("pro_elements").alias("pro_el"),
                                  "elementor_pro"), "site_id", "left")
    royal = F.coalesce(F.col("royal_elements"), F.lit(False))
    pro = F.coalesce(F.col("elementor_pro"), F.lit(False)) | F.coalesce(F.col("pro_el"), F.lit(False))
    return j.select(
        "page_id", "has_wpr", "has_pro",
        (F.col("has_wpr") & ~royal).alias("wpr_warning"),
        (F.col("has_pro") & ~pro).alias("pro_warning"),
    )


def tree_set_h1_action(nodes: DataFrame) -> DataFrame:
    """What setting an H1 title does per page: updated / converted_from_h2 / created.

    First heading widget (pre-order) with header_size h1 -> ``updated``; else the
    first with h2 or h3 -> ``converted_from_h2``; else ``created`` (a new
    section is prepended). Target node path is reported.
    """
    raw = setting("header_size")
    hs = F.when(raw.isNull() | F.is_variant_null(raw), F.lit("h2")).otherwise(vstring(raw))
    is_head = F.col("widgetType") == "heading"
    per_page = nodes.groupBy("page_id").agg(
        F.min(F.when(is_head & (hs == "h1"), F.col("path"))).alias("h1_path"),
        F.min(F.when(is_head & hs.isin("h2", "h3"), F.col("path"))).alias("h23_path"),
    )
    action = (F.when(F.col("h1_path").isNotNull(), F.lit("updated"))
              .when(F.col("h23_path").isNotNull(), F.lit("converted_from_h2")).otherwise(F.lit("created")))
    target = F.coalesce(F.col("h1_path"), F.col("h23_path"))
    return per_page.select("page_id", action.alias("action"), target.alias("path"),
                           F.array_join(target.cast("array<string>"), ".").alias("target_path"))


def tree_set_h1(trees: DataFrame, titles: DataFrame, id_col: str = "page_id", json_col: str = "tree_json") -> DataFrame:
    """(page_id, action, target_path, tree_json): every tree of ``titles`` (page_id, title) with its H1 set.

    Where the heading stands is found natively; only the changed trees' JSON is written
    by a small Arrow-batched UDF. A page without a heading gets a section on top.
    """
    from pagelens.functions.pyudf import rewrite_h1

    wanted = trees.select(F.col(id_col).alias("page_id"), F.col(json_col).alias("_tree")).join(
        titles.select(F.col("page_id").alias("_p"), F.col("title").alias("_title")), F.col("page_id") == F.col("_p")).drop("_p")
    act = tree_set_h1_action(tree_nodes(wanted.select("page_id", F.col("_tree").alias("tree_json"))))
    j = wanted.join(act, "page_id", "left")
    seed = F.md5(F.concat(F.lit("h1-"), F.col("page_id").cast("string")))
    return j.select("page_id", F.coalesce("action", F.lit("created")).alias("action"), "target_path",
                    rewrite_h1("_tree", "_title", "path", seed).alias("tree_json"))


# Flat-builder settings that hold an image (reference order).
FLAT_IMAGE_FIELDS = ("photo", "bg_image", "photo_source", "image", "poster", "ss_photo")


def flat_builder_images(flat: DataFrame, attachments: DataFrame, id_col: str = "page_id",
                        json_col: str = "flat_json") -> DataFrame:
    """Images of flat builder nodes: numeric ids -> attachment (url, alt, size); URL strings as is."""
    from pagelens.operators.media import is_valid_url
    nodes = flat.select(F.col(id_col).alias("page_id"),
                        F.posexplode(F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", "array<variant>"))
                        .alias("n", "node"))
    fields = F.array(*[F.struct(F.lit(i).alias("f"),
                                F.try_variant_get("node", f"$.settings['{f}']", "variant").alias("v"))
                       for i, f in enumerate(FLAT_IMAGE_FIELDS)])
    fv = (nodes.select("page_id", "n", F.explode(fields).alias("x"))
          .select("page_id", "n", "x.f", F.col("x.v").alias("v")).filter(F.col("v").isNotNull()))
    s = F.try_variant_get("v", "$", "string")
    numeric = s.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    att = attachments.select(F.col("id").alias("_aid"), F.col("source_url").alias("_url"), F.col("alt").alias("_alt"),
                             F.col("width").cast("string").alias("_w"), F.col("height").cast("string").alias("_h"))
    by_id = (fv.filter(numeric).withColumn("_aid", s.cast("double").cast("bigint"))
             .join(att, "_aid").filter(~falsy(F.col("_url")))
             .select("page_id", "n", "f", F.col("_url").alias("src"), F.coalesce("_alt", F.lit("")).alias("alt"),
                     F.coalesce("_w", F.lit("")).alias("width"), F.coalesce("_h", F.lit("")).alias("height")))
    by_url = (fv.filter(~numeric & (vkind(F.col("v")) == "string") & is_valid_url(s))
              .select("page_id", "n", "f", s.alias("src"), F.lit("").alias("alt"), F.lit("").alias("width"),
                      F.lit("").alias("height")))
    rows = by_id.unionByName(by_url)
    w = Window.partitionBy("page_id").orderBy("n", "f")
    return rows.select("page_id", F.row_number().over(w).cast("bigint").alias("pos"), "src", "alt", "width", "height",
                       (~falsy(F.col("alt"))).alias("has_alt"), F.lit("beaver_builder").alias("source"))
