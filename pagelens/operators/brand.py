"""Brand tokens: colour and font frequencies over builder pages, merged with
site-kit globals and assigned to semantic slots.

Per site the work is: flatten the trees of all published builder pages (row-local),
count colours/fonts (partial aggregation), keep the top 20/10 (window top-k),
then the order-dependent merge and slot assignment run as ``aggregate()`` folds over
arrays of at most ~30 rows per site. A hot site only ever moves its partial counts,
never all its pages, through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions import color as C
from pagelens.functions.common import falsy
from pagelens.operators import tree as TR

TOP_COLORS = 20
TOP_FONTS = 10
PAGE_LIMIT = 10
GLOBAL_FREQUENCY = 999
SIMILAR = 30.0


def builder_pages_limit(posts: DataFrame, trees: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """First ``limit`` published pages/posts with builder data per site, by menu order."""
    cand = (posts.filter(F.col("post_type").isin("page", "post") & (F.col("post_status") == "publish"))
            .join(trees.select(F.col("page_id").alias("id")), "id", "left_semi"))
    w = Window.partitionBy("site_id").orderBy("menu_order", "id")
    return (cand.withColumn("page_rank", F.row_number().over(w)).filter(F.col("page_rank") <= limit)
            .select("site_id", F.col("id").alias("page_id"), "page_rank"))


def builder_pages(posts: DataFrame) -> DataFrame:
    """All published pages and posts with their place in menu order (``page_rank``: menu order, then id)."""
    pub = posts.filter(F.col("post_type").isin("page", "post") & (F.col("post_status") == "publish"))
    return pub.select("site_id", F.col("id").alias("page_id"), F.struct("menu_order", "id").alias("page_rank"))


def analyzed_nodes(posts: DataFrame, trees: DataFrame, limit: int | None = None) -> DataFrame:
    """Flattened nodes of all published builder pages, or of the first ``limit`` per site."""
    pages = builder_pages(posts) if limit is None else builder_pages_limit(posts, trees, limit)
    return TR.tree_nodes(trees.select("page_id", "tree_json").join(pages, "page_id"), keep=("site_id", "page_rank"))


def analyzed_settings(posts: DataFrame, trees: DataFrame, limit: int | None = None) -> DataFrame:
    """Setting rows of the analysed pages."""
    return setting_rows(analyzed_nodes(posts, trees, limit))


def setting_rows(nodes: DataFrame) -> DataFrame:
    """(site_id, page_rank, path, elType, key, value) for every node setting."""
    m = F.try_variant_get(F.col("settings"), "$", "map<string,variant>")
    return nodes.select("site_id", "page_rank", "path", "elType", F.explode(m).alias("key", "value"))



def color_frequency(settings: DataFrame) -> DataFrame:
    """Per site: normalized colour -> count, contexts (the distinct keys in first-seen order).

    Counted per (site, colour, key) first, so what is gathered per colour grows with the number of
    setting names, not with the pages.
    """
    val = TR.vstring(F.col("value"))
    rows = (settings.filter(C.is_color_property(F.col("key")) & C.is_valid_color(val))
            .select("site_id", "page_rank", "path", "key", C.normalize_hex(val).alias("color"))
            .filter(F.col("color").isNotNull()))
    per_key = rows.groupBy("site_id", "color", "key").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("page_rank", "path", "key")).alias("_seen"))
    return (per_key.groupBy("site_id", "color")
            .agg(F.sum("_n").cast("bigint").alias("count"), F.min("_seen").alias("first_seen"),
                 F.array_sort(F.collect_list("_seen")).alias("_ctx"))
            .withColumn("contexts", F.transform("_ctx", lambda x: x["key"])).drop("_ctx"))


def _family_rows(settings: DataFrame) -> DataFrame:
    v = F.col("value")
    kind = TR.vkind(v)
    fam_obj = F.when(kind == "object", F.try_variant_get(v, "$.font_family", "variant"))
    family = F.when(fam_obj.isNotNull(), TR.vstring(fam_obj)).when(kind == "string", TR.vstring(v))
    weight = F.when(kind == "object", F.try_variant_get(v, "$.font_weight", "string"))
    rows = settings.filter(C.is_typography_property(F.col("key")))
    rows = rows.filter(fam_obj.isNotNull() | ((kind == "string") & ~falsy(TR.vstring(v))))
    return (rows.select("site_id", "page_rank", "path", "key", family.alias("family"),
                        C.php_intval(weight).alias("weight"))
            .filter(~falsy(F.col("family")) & (F.col("family") != "inherit")))


def font_frequency(settings: DataFrame) -> DataFrame:
    """Per site: font family -> count, distinct non-zero weights in first-seen order."""
    per_weight = _family_rows(settings).groupBy("site_id", "family", "weight").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("page_rank", "path", "key")).alias("_seen"))
    agg = (per_weight.groupBy("site_id", "family")
           .agg(F.sum("_n").cast("bigint").alias("count"), F.min("_seen").alias("first_seen"),
                F.array_sort(F.collect_list(F.when(F.col("weight") != 0, F.struct("_seen", "weight")))).alias("_w")))
    return agg.withColumn("weights", F.transform("_w", lambda x: x["weight"])).drop("_w")


def top_k(freq: DataFrame, k: int) -> DataFrame:
    """Rank per site by count desc, first seen asc; keep the first ``k``."""
    w = Window.partitionBy("site_id").orderBy(F.col("count").desc(), F.col("first_seen"))
    return freq.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def spacing_tokens(settings: DataFrame) -> DataFrame:
    """Per site: last section padding and container width seen (sections/containers)."""
    v = F.col("value")
    order = F.struct("page_rank", "path", "key")
    sec = settings.filter(F.col("elType").isin("section", "container"))
    pad = F.when((F.col("key") == "padding") & TR.vkind(v).isin("array", "object"), F.to_json(v))
    size = F.try_variant_get(v, "$.size", "string")
    unit = F.coalesce(F.try_variant_get(v, "$.unit", "string"), F.lit("px"))
    width = F.when((F.col("key") == "content_width") & TR.vkind(v).isin("array", "object") & size.isNotNull(),
                   F.concat(size, unit))
    return sec.groupBy("site_id").agg(
        F.max_by(pad, F.when(pad.isNotNull(), order)).alias("section_padding"),
        F.max_by(width, F.when(width.isNotNull(), order)).alias("container_width"))


def kit_tokens(kit: DataFrame) -> DataFrame:
    """Site kit globals as rows (site_id, section, pos, key, name, value, weight).

    Colours: system then custom (``custom_`` + id), entries need id and colour;
    typography: system then custom, entries need an id; buttons: text and
    background colour, border radius, typography family/weight. A repeated id
    keeps its first position and takes the later value.
    """
    v = F.try_parse_json(F.col("settings_json"))

    def listed(path: str, section: str, prefix: str, need_color: bool, default_title: Column | None):
        arr = F.try_variant_get(v, path, "array<variant>")
        e = F.col("e")
        _id = F.try_variant_get(e, "$._id", "string")
        title = F.try_variant_get(e, "$.title", "string")
        rows = kit.select("site_id", F.posexplode(arr).alias("i", "e"))
        keep = ~falsy(_id)
        if need_color:
            keep = keep & ~falsy(F.try_variant_get(e, "$.color", "string"))
        value = (F.try_variant_get(e, "$.color", "string") if need_color
                 else F.try_variant_get(e, "$.typography_font_family", "string"))
        weight = None if need_color else F.try_variant_get(e, "$.typography_font_weight", "string")
        return rows.filter(keep).select(
            "site_id", F.lit(section).alias("section"), "i",
            F.concat(F.lit(prefix), _id).alias("key"),
            F.coalesce(title, default_title if default_title is not None else C.ucfirst(_id)).alias("name"),
            value.alias("value"),
            (weight if weight is not None else F.lit(None).cast("string")).alias("weight"))

    parts = [
        listed("$.system_colors", "color", "", True, None).withColumn("grp", F.lit(0)),
        listed("$.custom_colors", "color", "custom_", True, F.lit("Custom")).withColumn("grp", F.lit(1)),
        listed("$.system_typography", "typography", "", False, None).withColumn("grp", F.lit(0)),
        listed("$.custom_typography", "typography", "custom_", False, F.lit("Custom")).withColumn("grp", F.lit(1)),
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    order = F.struct("grp", "i")
    merged = (rows.groupBy("site_id", "section", "key")
              .agg(F.min(order).alias("first"), F.max_by(F.struct("name", "value", "weight"), order).alias("last"))
              .select("site_id", "section", "key", "first", "last.*"))
    w = Window.partitionBy("site_id", "section").orderBy("first")
    listed_rows = merged.select("site_id", "section", F.row_number().over(w).alias("pos"), "key", "name", "value",
                                "weight")

    def button(path: str, key: str, cond: Column | None = None, weight: Column | None = None):
        raw = F.try_variant_get(v, path, "string")
        keep = ~falsy(raw) if cond is None else cond
        wt = weight if weight is not None else F.lit(None).cast("string")
        return kit.filter(keep).select("site_id", F.lit("button").alias("section"), F.lit(0).alias("pos"),
                                       F.lit(key).alias("key"), F.lit(None).cast("string").alias("name"),
                                       raw.alias("value"), wt.alias("weight"))
    typo_on = ~falsy(F.try_variant_get(v, "$.button_typography_typography", "string"))
    buttons = (button("$.button_typography_font_family", "typography", typo_on,
                      F.try_variant_get(v, "$.button_typography_font_weight", "string"))
               .unionByName(button("$.button_text_color", "text_color"))
               .unionByName(button("$.button_background_color", "background_color"))
               .unionByName(button("$.button_border_radius", "border_radius")))
    return listed_rows.unionByName(buttons)


COLOR_T = ("struct<kid:string,value:string,source:string,name:string,frequency:bigint,contexts:array<string>,"
           "rgb:struct<r:int,g:int,b:int>,lum:double>")


def _color_struct(kid, value, source, name, frequency, contexts, rgb) -> Column:
    """Colour record; rgb/luminance are computed once here, not inside the folds."""
    return F.struct(kid.alias("kid"), value.alias("value"), source.alias("source"), name.alias("name"),
                    frequency.cast("bigint").alias("frequency"), contexts.alias("contexts"), rgb.alias("rgb"),
                    C.luminance(rgb).cast("double").alias("lum"))


def color_merge(kit_rows: DataFrame, top_colors: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """Per site: global colours, then extracted top colours not similar to any kept one.

    Returns (site_id, colors ARRAY<struct>) in merge order. The fold runs over
    at most ``TOP_COLORS`` candidates per site.
    """
    g = (kit_rows.filter(F.col("section") == "color").withColumn("_rgb", C.hex_to_rgb(F.col("value")))
         .groupBy("site_id").agg(F.array_sort(F.collect_list(F.struct(
             "pos", _color_struct(F.col("key"), F.col("value"), F.lit("global"), F.col("name"),
                                  F.lit(GLOBAL_FREQUENCY), F.expr("CAST(array() AS array<string>)"),
                                  F.col("_rgb")).alias("c"))))
             .alias("_g"))
         .select("site_id", F.transform("_g", lambda x: x["c"]).alias("globals")))
    e = (top_colors.withColumn("_hex", C.normalize_hex(F.col("color"))).filter(F.col("_hex").isNotNull())
         .withColumn("_rgb", C.hex_to_rgb(F.col("_hex")))
         .withColumn("_name", C.color_name(F.col("_hex"), F.col("contexts"), F.col("_rgb")))
         .groupBy("site_id").agg(F.array_sort(F.collect_list(F.struct(
             "rank", _color_struct(F.col("_hex"), F.col("_hex"), F.lit("extracted"), F.col("_name"),
                                   F.col("count"), F.slice(F.col("contexts"), 1, 5), F.col("_rgb")).alias("c"))))
             .alias("_e"))
         .select("site_id", F.transform("_e", lambda x: x["c"]).alias("extracted")))
    j = g.join(e, "site_id", "full")
    empty = F.expr(f"CAST(array() AS array<{COLOR_T}>)")
    start = F.coalesce(F.col("globals"), empty)

    def step(acc, c):
        similar = F.exists(acc, lambda a: C.color_distance_lt(a["rgb"], c["rgb"], threshold))
        return F.when(similar, acc).otherwise(F.concat(acc, F.array(c)))
    merged = F.aggregate(F.coalesce(F.col("extracted"), empty), start, step)
    return j.select("site_id", merged.alias("colors"))


# Colour slots in the reference's order.
COLOR_SLOTS = ("primary", "secondary", "accent", "text", "heading", "background", "buttonBg", "buttonText")


def color_slots(merged: DataFrame, max_additional: int = 5) -> DataFrame:
    """Greedy slot assignment per site (ordered fold over colours by frequency).

    State = (slots: array of the 8 named slots, additional: array). Output
    rows (site_id, slot, ord, value, name, source, frequency); the
    ``additional`` slot keeps its first ``max_additional`` entries.
    """
    idx = F.transform("colors", lambda c, i: F.struct((-c["frequency"]).alias("f"), i.alias("i"), c.alias("c")))
    ordered = F.transform(F.array_sort(idx), lambda x: x["c"])
    k = {name: i for i, name in enumerate(COLOR_SLOTS)}
    init = F.struct(F.array(*[F.lit(None).cast(COLOR_T)] * len(COLOR_SLOTS)).alias("slots"),
                    F.expr(f"CAST(array() AS array<{COLOR_T}>)").alias("additional"))

    def step(acc, c):
        slots = acc["slots"]
        has = lambda s: F.element_at(slots, k[s] + 1).isNotNull()
        put = lambda s: F.struct(F.transform(slots, lambda x, i: F.when(i == k[s], c).otherwise(x)).alias("slots"),
                                 acc["additional"].alias("additional"))
        add = F.struct(slots.alias("slots"), F.concat(acc["additional"], F.array(c)).alias("additional"))
        lum = c["lum"]
        name = F.lower(F.coalesce(c["name"], F.lit("")))
        cont = lambda x: F.contains(name, F.lit(x))
        glob = (F.when(cont("primary") & ~has("primary"), put("primary"))
                .when(cont("secondary") & ~has("secondary"), put("secondary"))
                .when(cont("accent") & ~has("accent"), put("accent"))
                .when(cont("text") & ~has("text"), put("text"))
                .otherwise(add))
        mid = (lum > 0.2) & (lum < 0.8)
        ext = (F.when(cont("button"), F.when(~has("buttonBg"), put("buttonBg"))
                      .when(~has("buttonText"), put("buttonText")).otherwise(acc))
               .when(cont("heading") & ~has("heading"), put("heading"))
               .when(cont("background") & (lum > 0.7) & ~has("background"), put("background"))
               .when((lum < 0.3) & ~has("text"), put("text"))
               .when(~has("primary") & mid, put("primary"))
               .when(~has("secondary") & mid, put("secondary"))
               .otherwise(add))
        return (F.when(c["rgb"].isNull(), acc)
                .when(F.coalesce(c["source"], F.lit("extracted")) == "global", glob).otherwise(ext))

    slots = merged.select("site_id", F.aggregate(ordered, init, step).alias("s"))
    named = F.transform(F.col("s.slots"), lambda c, i: F.struct(
        F.element_at(F.array(*[F.lit(n) for n in COLOR_SLOTS]), i + 1).alias("slot"), F.lit(0).alias("ord"),
        c.alias("c")))
    extra = F.transform(F.slice(F.col("s.additional"), 1, max_additional),
                        lambda c, i: F.struct(F.lit("additional").alias("slot"), i.alias("ord"), c.alias("c")))
    rows = slots.select("site_id", F.explode(F.concat(named, extra)).alias("x"))
    return rows.filter(F.col("x.c").isNotNull()).select(
        "site_id", "x.slot", "x.ord", "x.c.value", "x.c.name", "x.c.source", "x.c.frequency")


def font_merge(kit_rows: DataFrame, top_fonts: DataFrame) -> DataFrame:
    """Global fonts, then extracted top fonts not already present (case-insensitive).

    Rows: (site_id, pos, family, source, name, weights, frequency); globals
    have no frequency (NULL). Extracted families are trimmed; empty and
    'inherit' are skipped.
    """
    g = (kit_rows.filter(F.col("section") == "typography")
         .select("site_id", F.col("pos").cast("bigint").alias("pos"), F.col("value").alias("family"),
                 F.lit("global").alias("source"), "name",
                 C.font_weights(F.col("weight")).alias("weights"), F.lit(None).cast("bigint").alias("frequency")))
    fam = F.btrim(F.col("family"), F.lit(" \t\n\r\x00\x0b"))
    e = (top_fonts.select("site_id", "rank", fam.alias("family"), "weights", "count")
         .filter((F.col("family") != "") & (F.lower("family") != "inherit")))
    w = Window.partitionBy("site_id", F.lower("family")).orderBy("rank")
    e = e.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    gl = g.select("site_id", F.lower(F.coalesce("family", F.lit(""))).alias("_lf")).distinct()
    e = e.join(gl, (e.site_id == gl.site_id) & (F.lower(e.family) == gl._lf), "left_anti")
    n_g = g.groupBy("site_id").agg(F.count(F.lit(1)).alias("_ng"))
    w2 = Window.partitionBy("site_id").orderBy("rank")
    e = (e.join(n_g, "site_id", "left")
         .select("site_id", (F.coalesce("_ng", F.lit(0)) + F.row_number().over(w2)).cast("bigint").alias("pos"),
                 "family", F.lit("extracted").alias("source"), F.concat(F.lit("Font: "), "family").alias("name"),
                 "weights", F.col("count").alias("frequency")))
    return g.unionByName(e)


FONT_SLOTS = ("primary", "body", "secondary", "heading")


def font_slots(fonts: DataFrame, max_additional: int = 3) -> DataFrame:
    """Rank by frequency desc (globals count as 0, so they follow extracted ones).

    Rank 0 -> primary and body, rank 1 -> secondary and heading, then up to
    ``max_additional`` additional fonts.
    """
    w = Window.partitionBy("site_id").orderBy(F.coalesce("frequency", F.lit(0)).desc(), "pos")
    r = fonts.withColumn("_i", F.row_number().over(w) - 1)
    slots = F.when(F.col("_i") == 0, F.array(F.lit("primary"), F.lit("body"))) \
        .when(F.col("_i") == 1, F.array(F.lit("secondary"), F.lit("heading"))) \
        .when(F.col("_i") < 2 + max_additional, F.array(F.lit("additional")))
    return (r.filter(slots.isNotNull())
            .select("site_id", F.explode(slots).alias("slot"),
                    F.when(F.col("_i") >= 2, F.col("_i") - 2).otherwise(0).cast("int").alias("ord"),
                    "family", "source", "name", "frequency"))


def brand_tokens(color_slot_rows: DataFrame, font_slot_rows: DataFrame, spacing: DataFrame,
                 pages: DataFrame) -> DataFrame:
    """One token record per site: colours, typography, spacing, pages analysed, version, status."""
    cs = color_slot_rows.groupBy("site_id").agg(F.to_json(F.array_sort(F.collect_list(
        F.struct("slot", "ord", "value", "name", "source", "frequency")))).alias("colors"))
    fs = font_slot_rows.groupBy("site_id").agg(F.to_json(F.array_sort(F.collect_list(
        F.struct("slot", "ord", "family", "source", "name", "frequency")))).alias("typography"))
    pa = pages.groupBy("site_id").agg(F.count(F.lit(1)).cast("bigint").alias("pages_analyzed"))
    sp = spacing.select("site_id", F.to_json(F.struct("section_padding", "container_width")).alias("spacing"))
    return (pa.join(cs, "site_id", "full").join(fs, "site_id", "full").join(sp, "site_id", "full")
            .select("site_id", F.coalesce("pages_analyzed", F.lit(0)).alias("pages_analyzed"),
                    "colors", "typography", "spacing", F.lit(1).alias("version"), F.lit("draft").alias("status")))


def brand_token_rows(color_slot_rows: DataFrame, font_slot_rows: DataFrame, spacing: DataFrame,
                     pages: DataFrame) -> DataFrame:
    """The token record as scalar rows: (site_id, section, slot, ord, value, name, source, frequency).

    Sections: colors, typography, spacing, meta (pagesAnalyzed, version, status).
    """
    cols = ["site_id", "section", "slot", "ord", "value", "name", "source", "frequency"]
    c = color_slot_rows.select("site_id", F.lit("colors").alias("section"), "slot", "ord", "value", "name", "source",
                               F.col("frequency").cast("bigint").alias("frequency"))
    f = font_slot_rows.select("site_id", F.lit("typography").alias("section"), "slot", "ord",
                              F.col("family").alias("value"), "name", "source",
                              F.col("frequency").cast("bigint").alias("frequency"))
    sp = spacing.select("site_id", F.explode(F.array(
        F.struct(F.lit("section_padding").alias("slot"), F.col("section_padding").alias("value")),
        F.struct(F.lit("container_width").alias("slot"), F.col("container_width").alias("value")))).alias("x"))
    sp = sp.filter(F.col("x.value").isNotNull()).select(
        "site_id", F.lit("spacing").alias("section"), F.col("x.slot").alias("slot"), F.lit(0).alias("ord"),
        F.col("x.value").alias("value"), *[F.lit(None).cast(t).alias(n) for n, t in
                                           (("name", "string"), ("source", "string"), ("frequency", "bigint"))])
    pa = pages.groupBy("site_id").agg(F.count(F.lit(1)).alias("n"))
    meta = pa.select("site_id", F.explode(F.array(
        F.struct(F.lit("pagesAnalyzed").alias("slot"), F.col("n").cast("string").alias("value")),
        F.struct(F.lit("version").alias("slot"), F.lit("1").alias("value")),
        F.struct(F.lit("status").alias("slot"), F.lit("draft").alias("value")))).alias("x")).select(
        "site_id", F.lit("meta").alias("section"), F.col("x.slot").alias("slot"), F.lit(0).alias("ord"),
        F.col("x.value").alias("value"), *[F.lit(None).cast(t).alias(n) for n, t in
                                           (("name", "string"), ("source", "string"), ("frequency", "bigint"))])
    return c.select(*cols).unionByName(f.select(*cols)).unionByName(sp.select(*cols)).unionByName(meta.select(*cols))
