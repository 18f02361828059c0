"""HTML -> builder widget rows, from the element tree that one fold over a page's tokens gives (``elements``).

Walk (document order, per page), *outermost* widget elements only; what stands inside
one is part of it:
* elements with ``data-elementor="<type>"`` of a known type -> that special widget;
* h1-h6 -> ``heading`` (plain text, size and alignment), p -> ``text-editor`` with its inner html;
* ``img`` with a src -> ``image``; ``hr`` -> ``divider``; ``a`` with a btn/button class -> ``button``;
* other ``a``, ``ul``, ``ol``, ``blockquote``, ``span``/``strong``/``em``/``b``/``i`` -> ``text-editor`` with their markup;
  ``table``, ``form``, ``iframe``, ``video``, ``audio``, ``canvas``, ``svg`` -> ``html`` with theirs;
* text in containers (div, section, ...) -> ``text-editor``; other elements that hold no widget
  at all -> ``text-editor`` with their markup;
* outermost section/header/footer/article/main elements are sections of their own, with the
  settings that their class gives; widgets between them form sections without settings;
* a page without any widget becomes one ``text-editor`` with the whole html.

Everything is row-local: pages are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.operators import blocks as B
from pagelens.operators import elements as E

SECTION_TAGS = ("section", "header", "footer", "article", "main")
PLAIN_TAGS = ("div", "section", "article", "aside", "main")
HTML_WIDGET_TAGS = ("table", "form", "iframe", "video", "audio", "canvas", "svg")
LIST_TAGS = ("ul", "ol")
INLINE_TEXT_TAGS = ("span", "strong", "em", "b", "i")
HIDDEN_TAGS = ("head", "title")
# Heading sizes by tag.
HEADING_SIZES = (("h1", "xl"), ("h2", "large"), ("h3", "medium"), ("h4", "small"), ("h5", "small"), ("h6", "small"))
# Icon names with a class of their own (``fa fa-<name>``) in icon boxes; other names stay as written.
BOX_ICONS = ("wrench", "check", "star", "phone", "clock", "shield", "home", "users", "cog", "bolt", "heart", "thumbs-up", "award",
             "certificate")
# Icon names of list items; an item with another name takes the list's, a list with another name a check mark.
LIST_ICONS = ("check", "check-circle", "star", "arrow-right", "chevron-right")
# Data-elementor types with their own widget builders.
SPECIAL_TYPES = ("icon-box", "icon-list", "counter", "testimonial", "call-to-action", "accordion",
                 "star-rating", "button")
# What stands in for missing texts.
FAQ_TITLE, CTA_BUTTON, CUSTOMER, BOX_ICON, LIST_ICON = "Frequently Asked Questions", "Learn More", "Customer", "fa fa-star", "fa fa-check"


def _kind(token: Column) -> Column:
    """The widget type of an element that is a widget of its own; ``skip`` for elements that show nothing."""
    name, special = token["name"], E.attr(token["attrs"], "data-elementor")
    return (F.when(special.isin(*SPECIAL_TYPES), special).when(name.isin(*HIDDEN_TAGS), "skip")
            .when(name.isin(*B.HEADINGS), "heading").when(name.isin("p", "blockquote", *LIST_TAGS, *INLINE_TEXT_TAGS), "text-editor")
            .when(name == "img", "image").when(name == "hr", "divider")
            .when(name == "a", F.when(E.attr(token["attrs"], "class").rlike("btn|button"), "button").otherwise("text-editor"))
            .when(name.isin(*HTML_WIDGET_TAGS), "html"))


def with_nodes(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``page_id, _html, _toks, _nodes`` of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("_html"), E.tokens(F.coalesce(F.col(html_col), F.lit(""))).alias("_toks"))
    return rows.select("*", E.nodes(F.col("_toks"), _kind, PLAIN_TAGS, SECTION_TAGS).alias("_nodes"))


WIDGET_COLS = ("page_id", "section", "pos", "widgetType", "tag", "text", "src", "alt", "align", "size", "link", "content",
               "section_background", "section_padding")


def _section_background(cls: Column) -> Column:
    """Background of a section from its class's grey shade."""
    shade = F.regexp_extract(cls, r"(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\d+)", 1).try_cast("int")
    return F.when(shade >= 800, "#1f2937").when(shade >= 600, "#4b5563").when(shade >= 100, "#f3f4f6")


def html_to_widgets(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Widget rows: WIDGET_COLS.

    ``text`` is a widget's plain text (headings, paragraphs, links, buttons, loose text), ``content`` the editor's or html
    widget's markup; ``link`` a button's target, ``size`` and ``align`` a heading's; sections count from 0 and the section columns are the
    settings of the section that the widget stands in (background, padding top and bottom in px). A null
    page counts as an empty one: one ``text-editor`` without content.
    """
    rows = with_nodes(pages, id_col, html_col)
    toks = F.col("_toks")

    def widget(n: Column) -> Column:
        at = F.get(toks, n["p"])
        name, attrs, kind = at["name"], at["attrs"], n["t"]
        element = kind != "text"
        text = E.trimmed(F.when(element, E.text_content(toks, n["p"], n["e"])).otherwise(B.decode_entities(at["tail"])))
        outer = E.outer_markup(toks, n["p"], n["e"])
        inner = E.inner_markup(toks, n["p"], n["e"])
        content = (F.when(kind == "text", E.trimmed(at["tail"])).when(kind.isin("html", "hollow"), outer)
                   .when(kind == "text-editor", F.when(name == "p", F.concat(F.lit("<p>"), inner, F.lit("</p>")))
                         .when(name == "blockquote", F.concat(F.lit("<blockquote>"), inner, F.lit("</blockquote>")))
                         .when(name.isin(*INLINE_TEXT_TAGS), F.concat(F.lit("<p>"), outer, F.lit("</p>"))).otherwise(outer)))
        size = F.lit(None).cast("string")
        for tag, value in HEADING_SIZES:
            size = F.when(name == tag, value).otherwise(size)
        cls = E.attr(attrs, "class")
        align = F.when(cls.contains("text-center"), "center").when(cls.contains("text-right"), "right")
        shown = F.when(kind == "image", E.attr(attrs, "src") != "").when(name == "p", ~E.falsy(E.trimmed(inner)) | ~kind.isin("text-editor")).otherwise(kind != "skip")
        return F.struct(
            n["k"].alias("k"), n["s"].alias("s"), F.when(kind.isin("text", "hollow"), "text-editor").otherwise(kind).alias("widgetType"),
            F.when(element, name).alias("tag"), F.when((kind == "text") | name.isin(*B.BLOCK_TAGS, "a") | (kind == "button"), text).alias("text"),
            F.when(kind == "image", E.attr(attrs, "src")).alias("src"), F.when(kind == "image", E.attr(attrs, "alt")).alias("alt"),
            F.when(kind == "heading", align).when(kind.isin("image", "button"), "center").alias("align"), F.when(kind == "heading", size).alias("size"),
            F.when(kind == "button", E.attr(attrs, "href")).alias("link"), content.alias("content"), shown.alias("shown"))

    found = F.filter(F.transform(F.filter("_nodes", lambda n: n["t"].isNotNull()), widget), lambda w: w["shown"])
    # the classes of the outermost section elements; the kth is that of section number k
    tops = F.transform(F.filter("_nodes", lambda n: (n["u"] == -1) & F.get(toks, n["p"])["name"].isin(*SECTION_TAGS) & (n["t"].isNull() | ~n["t"].isin("text", "hollow"))),
                       lambda n: E.attr(F.get(toks, n["p"])["attrs"], "class"))
    none = F.lit(None)
    whole = F.struct(F.lit(0).alias("k"), F.lit(False).alias("s"), F.lit("text-editor").alias("widgetType"), none.alias("tag"), none.alias("text"), none.alias("src"), none.alias("alt"),
                     none.alias("align"), none.alias("size"), none.alias("link"), F.col("_html").alias("content"), F.lit(True).alias("shown"))
    rows = rows.select("page_id", "_html", tops.alias("_tops"), found.alias("_w"))
    rows = rows.withColumn("_w", F.when(F.size("_w") > 0, F.col("_w")).otherwise(F.array(whole)))
    # sections in order: section k, then what follows it
    key = lambda w: w["k"] * 2 + F.when(w["s"], 0).otherwise(1)
    rows = rows.withColumn("_keys", F.array_sort(F.array_distinct(F.transform("_w", key))))
    # an outer explode (there is always a widget): Spark would repeat the whole fold in a filter before an inner one
    rows = rows.select("page_id", "_tops", "_keys", F.posexplode_outer("_w").alias("_at", "_x"))
    cls = F.when(F.col("_x.s"), F.get("_tops", F.col("_x.k") - 1))
    return rows.select(
        "page_id", (F.array_position("_keys", key(F.col("_x"))) - 1).cast("bigint").alias("section"), (F.col("_at") + 1).alias("pos"),
        *[f"_x.{c}" for c in WIDGET_COLS[3:12]], _section_background(cls).alias("section_background"),
        (F.regexp_extract(cls, r"(?i)py-(\d+)", 1).try_cast("int") * 4).cast("bigint").alias("section_padding"))


def special_widgets(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Elements with data-elementor="<type>" that stand in no other widget: one row each with the settings its type reads.

    ``content`` is all its text. Icon boxes and calls to action take title and text from their own headings and paragraphs
    (other children do not count), calls to action button and link from their last link; counters carry number, prefix and suffix,
    testimonials name, company, rating and image, star ratings rating and scale, buttons their text and link. ``items`` are the
    entries of icon lists (text and icon of every child element with text) and accordions (title and text: from details/summary
    children and from div children with a heading or bold question; without any, one entry with all the text). PHP's
    falsy '0' counts as empty.
    """
    rows = with_nodes(pages, id_col, html_col)
    toks, nodes = F.col("_toks"), F.col("_nodes")

    def children(p: Column, deep: bool) -> Column:
        inside = F.filter(nodes, lambda n: (n["u"] == p) & (n["t"].isNull() | ~n["t"].isin("text", "hollow")))

        def child(n: Column) -> Column:
            out = [F.get(toks, n["p"])["name"].alias("name"), F.get(toks, n["p"])["attrs"].alias("attrs"), E.trimmed(E.text_content(toks, n["p"], n["e"])).alias("text")]
            return F.struct(*out, *([children(n["p"], False).alias("kids")] if deep else []))
        return F.transform(inside, child)

    found = F.transform(F.filter(nodes, lambda n: n["t"].isin(*SPECIAL_TYPES)), lambda n: F.struct(
        n["t"].alias("type"), F.get(toks, n["p"])["attrs"].alias("attrs"), E.trimmed(E.text_content(toks, n["p"], n["e"])).alias("content"),
        F.when(n["t"].isin("icon-box", "icon-list", "call-to-action", "accordion"), children(n["p"], True)).alias("kids")))
    rows = rows.select("page_id", F.posexplode(found).alias("_at", "_w"))
    kind, kids = F.col("_w.type"), F.col("_w.kids")
    attr = lambda name: E.attr(F.col("_w.attrs"), name)
    or_ = lambda c, default: F.when(E.falsy(c), default).otherwise(c)
    named = lambda of, *names: F.filter(of, lambda x: x["name"].isin(*names))
    joined = lambda of: E.trimmed(F.array_join(F.transform(of, lambda x: F.concat(x["text"], F.lit(" "))), ""))
    head = lambda *names: F.coalesce(F.get(F.filter(named(kids, *names), lambda x: ~E.falsy(x["text"])), F.lit(0))["text"], F.lit(""))
    box_icon = or_(attr("data-icon"), F.lit(BOX_ICON))
    list_icon = or_(attr("data-icon"), F.lit("check"))
    fa = lambda c: F.concat(F.lit("fa fa-"), c)
    link = F.try_element_at(named(kids, "a"), F.lit(-1))
    item = lambda title, text, icon: F.struct(title.alias("title"), text.alias("text"), icon.alias("icon"))
    nothing = F.lit(None).cast("string")
    entries = F.transform(F.filter(kids, lambda x: ~E.falsy(x["text"])), lambda x: item(nothing, x["text"], E.let(E.attr(x["attrs"], "data-icon"), lambda i: F.when(
        i.isin(*LIST_ICONS), fa(i)).otherwise(F.when(list_icon.isin(*LIST_ICONS), fa(list_icon)).otherwise(LIST_ICON)))))

    def pair(x: Column) -> Column:
        details = x["name"] == "details"
        asked = F.filter(x["kids"], lambda y: F.when(details, y["name"] == "summary").otherwise(y["name"].isin("h3", "h4", "h5", "strong", "b")))
        said = F.filter(x["kids"], lambda y: F.when(details, y["name"] != "summary").otherwise(y["name"].isin("p", "div", "span")))
        return item(F.try_element_at(asked, F.lit(-1))["text"], joined(said), nothing)

    pairs = F.filter(F.transform(named(kids, "details", "div"), pair), lambda x: ~E.falsy(x["title"]))
    faq = F.array(item(F.lit(FAQ_TITLE), F.col("_w.content"), nothing))
    when = lambda types, c: F.when(kind.isin(*types), c)
    number = lambda c: F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("bigint"), F.lit(0))
    return rows.select(
        "page_id", (F.col("_at") + 1).alias("pos"), kind.alias("widgetType"),
        when(["icon-box"], or_(head("h3", "h4", "h5"), F.col("_w.content"))).when(kind == "call-to-action", head("h2", "h3", "h4")).when(
            kind == "counter", F.col("_w.content")).alias("title"),
        when(["icon-box"], joined(named(kids, "p", "div", "span"))).when(kind == "call-to-action", joined(named(kids, "p"))).alias("text"),
        F.col("_w.content").alias("content"),
        when(["icon-box"], F.when(box_icon.isin(*BOX_ICONS), fa(box_icon)).otherwise(box_icon)).alias("icon"),
        when(["counter"], number(attr("data-number"))).alias("number"), when(["counter"], or_(attr("data-prefix"), F.lit(""))).alias("prefix"),
        when(["counter"], or_(attr("data-suffix"), F.lit(""))).alias("suffix"),
        when(["testimonial"], or_(attr("data-name"), F.lit(CUSTOMER))).alias("name"), when(["testimonial"], or_(attr("data-company"), F.lit(""))).alias("company"),
        when(["testimonial"], F.when(~E.falsy(attr("data-image")), attr("data-image"))).alias("image"),
        when(["testimonial", "star-rating"], F.regexp_extract(F.when((kind == "star-rating") & E.falsy(attr("data-rating")), "5").otherwise(attr("data-rating")),
                                                              r"^\s*([+-]?\d+(?:\.\d+)?)", 1).try_cast("double")).alias("rating"),
        when(["star-rating"], number(or_(attr("data-scale"), F.lit("5")))).alias("scale"),
        when(["button"], F.col("_w.content")).when(kind == "call-to-action", F.coalesce(link["text"], F.lit(CTA_BUTTON))).alias("button"),
        when(["button"], attr("href")).when(kind == "call-to-action", or_(E.attr(link["attrs"], "href"), F.lit("#"))).alias("link"),
        when(["icon-list"], entries).when(kind == "accordion", F.when(F.size(pairs) > 0, pairs).otherwise(faq)).alias("items"))
