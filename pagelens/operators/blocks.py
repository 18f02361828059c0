"""Content blocks without a DOM: html -> token rows -> windows.

Design (all JVM-side, no Python):

1. ``html_tokens``: drop comments and script/style bodies, ``split(html, '<')``
   and ``posexplode``; each piece is ``name attrs>tail``. The pages are
   hash-partitioned by ``page_id`` ONCE before the explode, so every later
   window and the block aggregation reuse that partitioning (no token shuffle).
2. ``main_content_scope``: the first of nine selectors that matches (by
   selector, then document order) and its matching close tag (depth of the
   same tag name), else the whole document (body).
3. ``block_rows``: h1-h6/p opens start blocks; a block ends at the next token
   that would close it (its own close, a heading/p open, a block-level open for
   ``p``, or a non-inline close such as the parent's). Text = the block's
   tails, each nested element trimmed, entities decoded, whitespace collapsed.
4. ``block_filters`` -> ``block_dedup`` (first per normalized text) ->
   ``block_cap`` (first 100), as window filters.
"""

from __future__ import annotations

import functools
import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.text import is_boilerplate, normalize_text

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCK_TAGS = HEADINGS + ("p",)
# Elements whose start tag implicitly closes an open <p> (HTML parsing rules).
P_CLOSERS = (
    "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hgroup", "hr", "li", "listing", "main", "menu", "nav", "ol", "p", "pre",
    "section", "table", "ul", "xmp",
)
# Phrasing elements: their end tags do not end an enclosing block.
INLINE = (
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "dfn", "em", "font", "i", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var",
)
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr")
# All named character references that end in a semicolon, from Python's own table of the HTML standard.
NAMED_ENTITIES = {name: char for name, char in html5.items() if name.endswith(";")}
WS_CLASS = "[ \\t\\n\\r\\f\\x0B]"
WS_CHARS = " \t\n\r\f\x0b"
BIG = 2 ** 31 - 1


def _hex2(n: Column) -> Column:
    return F.format_string("%02X", n.cast("int"))


def codepoint_to_str(cp: Column) -> Column:
    """The character of a Unicode code point (UTF-8 bytes built arithmetically)."""
    cp = cp.cast("bigint")
    b = lambda shift, mask, mark: _hex2(F.lit(mark).bitwiseOR(F.shiftright(cp, shift).bitwiseAND(F.lit(mask))))
    hexs = (F.when(cp < 0x80, _hex2(cp))
            .when(cp < 0x800, F.concat(b(6, 0x1F, 0xC0), b(0, 0x3F, 0x80)))
            .when(cp < 0x10000, F.concat(b(12, 0x0F, 0xE0), b(6, 0x3F, 0x80), b(0, 0x3F, 0x80)))
            .when(cp <= 0x10FFFF, F.concat(b(18, 0x07, 0xF0), b(12, 0x3F, 0x80), b(6, 0x3F, 0x80), b(0, 0x3F, 0x80))))
    return F.decode(F.unhex(hexs), "UTF-8")


ENTITY_RE = r"^(?:#[xX]([0-9A-Fa-f]+)|#([0-9]+)|([A-Za-z][A-Za-z0-9]*));"


def decode_entities(c: Column) -> Column:
    """Character references, named and numeric, decoded once; unknown ones stay as written."""
    names = F.from_json(F.lit(json.dumps(NAMED_ENTITIES)), "map<string,string>")

    def piece(p, i):
        part = lambda g: F.regexp_extract(p, ENTITY_RE, g)
        cp = F.when(part(1) != "", F.conv(part(1), 16, 10)).when(part(2) != "", part(2)).try_cast("bigint")
        char = F.when(part(3) != "", F.try_element_at(names, F.concat(part(3), F.lit(";")))).when(cp > 0, codepoint_to_str(cp))
        whole = F.length(F.regexp_extract(p, ENTITY_RE, 0))
        return (F.when(i == 0, p).when(char.isNotNull(), F.concat(char, F.substring(p, whole + 1, F.length(p))))
                .otherwise(F.concat(F.lit("&"), p)))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "&"), piece), "")).otherwise(c)


def clean_html(c: Column) -> Column:
    """Remove comments, then script/style elements with their bodies."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    return F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", "")


def _trim_end(c: Column) -> Column:
    """White space before the end, also before a last line separator, where ``$`` matches too."""
    return F.when(F.right(c, F.lit(1)).isin("\u0085", "\u2028", "\u2029"), F.regexp_replace(c, f"{WS_CLASS}+$", "")).otherwise(F.rtrim(c, F.lit(WS_CHARS)))


def _one_space(c: Column) -> Column:
    """Runs of white space as one space; a text of single spaces stays as it is, without a pattern."""
    other = [F.contains(c, F.lit(w)) for w in ("  ", *WS_CHARS[1:])]
    return F.when(functools.reduce(Column.__or__, other), F.regexp_replace(c, f"{WS_CLASS}{{2,}}|[\\t\\n\\r\\f\\x0B]", " ")).otherwise(c)


def html_tokens(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                num_partitions: int | None = None) -> DataFrame:
    """One row per ``<``-piece: (page_id, pos, name, is_close, is_tag, attrs, tail).

    ``name`` is '' for text pieces and declarations. Partitioned by page_id.
    """
    src = pages.select(F.col(id_col).alias("page_id"), clean_html(F.col(html_col)).alias("h"))
    src = src.repartition(num_partitions, "page_id") if num_partitions else src.repartition("page_id")
    pieces = src.select("page_id", F.posexplode(F.split("h", "<")).alias("pos", "piece"))
    piece, name = F.col("piece"), F.col("name")
    head = F.substring_index(piece, ">", 1)
    # one pattern per token, over the part before '>'; all else is cut by position
    pieces = pieces.withColumn("name", F.when(F.col("pos") > 0, F.lower(F.regexp_extract(head, r"^/?([A-Za-z][A-Za-z0-9]*)", 1))).otherwise(F.lit("")))
    is_elem = name != ""
    is_close = is_elem & piece.startswith("/")
    is_decl = (F.col("pos") > 0) & (piece.startswith("!") | piece.startswith("?"))
    gt = F.instr(piece, ">")
    tail_after_gt = F.when(gt > 0, F.substring(piece, gt + 1, F.length(piece))).otherwise(F.lit(""))
    return pieces.select(
        "page_id", F.col("pos").cast("int").alias("pos"), "name",
        is_close.alias("is_close"),
        is_elem.alias("is_tag"),
        F.when(is_elem, F.substring(head, F.length(name) + F.when(is_close, 2).otherwise(1), F.length(head)))
         .otherwise(F.lit("")).alias("attrs"),
        F.when(is_elem | is_decl, tail_after_gt)
         .when(F.col("pos") == 0, piece)
         .otherwise(F.concat(F.lit("<"), piece)).alias("tail"),
    )


CLASS_ATTR_RE = r"""(?is)\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""


def _class_attr(attrs: Column) -> Column:
    return F.regexp_extract(attrs, CLASS_ATTR_RE, 0)


# Main-content selectors in the reference's priority order.
MAIN_SELECTORS = ("main", "role=main", "article", "content", "main-content", "post-content",
                  "entry-content", "page-content", "elementor")


def selector_priority(name: Column, attrs: Column, cls: Column | None = None) -> Column:
    """1..9 = first selector this open tag matches; NULL when none.

    ``cls`` is the class attribute text, extracted once per token by the caller.
    """
    cls = _class_attr(attrs) if cls is None else cls
    role_main = attrs.rlike(r"""(?i)\brole\s*=\s*(?:"main"|'main'|main(?:[\s/>]|$))""")
    tests = [name == "main", role_main, name == "article"]
    tests += [F.contains(cls, F.lit(frag)) for frag in MAIN_SELECTORS[3:]]
    out = F.lit(None).cast("int")
    for i in range(len(tests), 0, -1):
        out = F.when(tests[i - 1], F.lit(i)).otherwise(out)
    return out


def main_content_scope(tokens: DataFrame) -> DataFrame:
    """Add ``scope_start``/``scope_end``: the main content element's span.

    Pages with no matching selector keep the whole document (body fallback). All windows go by (page_id, pos): one sort.
    """
    fwd = Window.partitionBy("page_id").orderBy("pos")
    page = fwd.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = fwd.rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("is_tag") & ~F.col("is_close")
    t = tokens.withColumn("_cls", F.when(opens, _class_attr(F.col("attrs"))))
    t = t.withColumn("prio", F.when(opens, selector_priority(F.col("name"), F.col("attrs"), F.col("_cls"))))
    best = F.min(F.when(F.col("prio").isNotNull(), F.struct(F.col("prio"), F.col("pos"), F.col("name")))).over(page)
    t = t.withColumn("scope", best)
    inside = (F.col("name") == F.col("scope.name")) & (F.col("pos") > F.col("scope.pos"))  # elements of the scope's name after its open
    t = t.withColumn("depth", F.sum(F.when(inside & opens, 1).when(inside & F.col("is_close"), -1).otherwise(0)).over(run))
    closes_scope = F.col("is_close") & inside & (F.col("depth") == -1)
    t = t.withColumn("scope_end", F.min(F.when(closes_scope, F.col("pos"))).over(page))
    return t.select(
        *tokens.columns,
        F.coalesce(F.col("scope.pos"), F.lit(-1)).alias("scope_start"),
        F.when(F.col("scope").isNull(), F.lit(BIG))
         .otherwise(F.coalesce(F.col("scope_end"), F.lit(BIG))).alias("scope_end"),
        F.col("scope.prio").alias("scope_selector"),
    )


def block_rows(tokens: DataFrame) -> DataFrame:
    """Raw h1-h6/p blocks (page_id, pos, tag, text) in document order.

    ``pos`` is the block's open-token position. Tokens keep their page
    partitioning; the final aggregation groups by (page_id, pos) in place.
    A token belongs to the last block opened before it while as many ends of
    that block's kind are counted as at its open: windows in one direction, one sort.
    """
    name, is_close, is_tag = F.col("name"), F.col("is_close"), F.col("is_tag")
    opens = is_tag & ~is_close
    non_inline_close = is_close & ~name.isin(*INLINE)
    term_p = (opens & name.isin(*P_CLOSERS)) | non_inline_close
    term_h = (opens & name.isin(*BLOCK_TAGS)) | non_inline_close
    is_block = opens & name.isin(*BLOCK_TAGS)

    fwd = Window.partitionBy("page_id").orderBy("pos")
    run = fwd.rowsBetween(Window.unboundedPreceding, 0)
    before = fwd.rowsBetween(Window.unboundedPreceding, -1)
    upto = fwd.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    t = tokens.withColumns({
        "ends_p": F.count(F.when(term_p, 1)).over(upto),
        "ends_h": F.count(F.when(term_h, 1)).over(upto),
        "last_p": F.max(F.when(term_p, F.col("pos"))).over(before),
        "last_h": F.max(F.when(term_h, F.col("pos"))).over(before),
        "next_close": F.lead(is_close, 1, False).over(fwd),
    })
    ends = lambda tag: F.when(tag == "p", F.col("ends_p")).otherwise(F.col("ends_h"))
    # a page given twice has each token twice: the second open of a block ends at its own place
    again = F.coalesce(F.when(name == "p", F.col("last_p")).otherwise(F.col("last_h")) == F.col("pos"), F.lit(False))
    t = t.withColumns({
        "bstart": F.last(F.when(is_block, F.col("pos")), ignorenulls=True).over(run),
        "bends": F.last(F.when(is_block, F.when(again, -1).otherwise(ends(name))), ignorenulls=True).over(run),
        "btag": F.last(F.when(is_block, name), ignorenulls=True).over(run),
    })
    t = t.filter(F.col("bstart").isNotNull() & (ends(F.col("btag")) == F.col("bends")))
    if "scope_start" in tokens.columns:
        t = t.filter((F.col("bstart") > F.col("scope_start")) & (F.col("bstart") < F.col("scope_end")))

    # decode once per token (the trims below reference the piece several times)
    t = t.withColumn("_dec", decode_entities(F.col("tail")))
    piece = F.col("_dec")
    piece = F.when(opens & ~name.isin(*VOID), F.ltrim(piece, F.lit(WS_CHARS))).otherwise(piece)
    t = t.withColumn("_piece", piece)
    piece = F.when(F.col("next_close"), _trim_end(F.col("_piece"))).otherwise(F.col("_piece"))
    parts = t.select("page_id", F.col("bstart").alias("pos"), F.col("btag").alias("tag"),
                     F.struct(F.col("pos").alias("p"), piece.alias("s")).alias("part"))
    grouped = parts.groupBy("page_id", "pos", "tag").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    # one column per step, so that a step is not built anew for each use of it
    joined = grouped.select("page_id", "pos", "tag", F.ltrim(F.array_join("parts.s", ""), F.lit(WS_CHARS)).alias("text"))
    return joined.withColumn("text", _trim_end(F.col("text"))).withColumn("text", _one_space(F.col("text")))


def block_filters(blocks: DataFrame, skip_boilerplate: bool) -> DataFrame:
    """Drop empty, short (p < 20 bytes, headings < 10) and optionally boilerplate blocks.

    The text is handed to the tests as a value: a plain filter would be pushed below the projection that builds the text and build it
    anew for each of the tests.
    """
    min_len = F.when(F.col("tag") == "p", F.lit(20)).otherwise(F.lit(10))

    def keep(t):
        ok = t.isNotNull() & (t != "") & (t != "0") & (F.octet_length(t) >= min_len)
        return ok & ~is_boilerplate(t) if skip_boilerplate else ok

    return blocks.withColumn("text", F.explode(F.filter(F.array("text"), keep)))


def block_dedup(blocks: DataFrame) -> DataFrame:
    """Keep the first block per normalized text (document order)."""
    w = Window.partitionBy("page_id", "norm").orderBy("pos")
    return (blocks.withColumn("norm", normalize_text(F.col("text")))
            .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "norm"))


def block_cap(blocks: DataFrame, cap: int | None = 100) -> DataFrame:
    """First ``cap`` blocks per page (all, if None); output pos = 1..n."""
    w = Window.partitionBy("page_id").orderBy("pos")
    return (blocks.withColumn("_rn", F.row_number().over(w)).filter(F.lit(True) if cap is None else F.col("_rn") <= cap)
            .select("page_id", F.col("_rn").cast("int").alias("pos"), "tag", "text"))


def content_blocks_main(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                        cap: int | None = None) -> DataFrame:
    """Blocks of the main content area of rendered pages."""
    tokens = main_content_scope(html_tokens(pages, id_col, html_col))
    return block_cap(block_dedup(block_filters(block_rows(tokens), True)), cap)


def content_blocks_html(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                        cap: int | None = None) -> DataFrame:
    """Blocks of a whole html fragment (no scope, no phrase filter)."""
    return block_cap(block_dedup(block_filters(block_rows(html_tokens(pages, id_col, html_col)), False)), cap)


def content_blocks_smart(main: DataFrame, builder: DataFrame, fragment: DataFrame) -> DataFrame:
    """Per page, the first non-empty source: rendered main -> builder -> post content.

    Each input has (page_id, pos, tag, text); the choice is a per-page source
    rank (min over the union) joined back, no Python.
    """
    tagged = (main.withColumn("src", F.lit(1)).unionByName(builder.withColumn("src", F.lit(2)))
              .unionByName(fragment.withColumn("src", F.lit(3))))
    w = Window.partitionBy("page_id")
    return (tagged.withColumn("_best", F.min("src").over(w)).filter(F.col("src") == F.col("_best"))
            .drop("_best"))


def block_spans(tokens: DataFrame) -> DataFrame:
    """(page_id, pos, bend): every h1-h6/p open and the token position that ends it.

    Same termination rule as ``block_rows`` (own close, next heading/p open,
    block-level open for p, non-inline close).
    """
    name, is_close, is_tag = F.col("name"), F.col("is_close"), F.col("is_tag")
    opens = is_tag & ~is_close
    non_inline_close = is_close & ~name.isin(*INLINE)
    term_p = (opens & name.isin(*P_CLOSERS)) | non_inline_close
    term_h = (opens & name.isin(*BLOCK_TAGS)) | non_inline_close
    back = Window.partitionBy("page_id").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, -1)
    t = tokens.withColumns({
        "next_tp": F.last(F.when(term_p, F.col("pos")), ignorenulls=True).over(back),
        "next_th": F.last(F.when(term_h, F.col("pos")), ignorenulls=True).over(back),
    })
    bend = F.coalesce(F.when(name == "p", F.col("next_tp")).otherwise(F.col("next_th")), F.lit(BIG))
    return t.filter(opens & name.isin(*BLOCK_TAGS)).select("page_id", "pos", bend.alias("bend"))


def element_ends(tokens: DataFrame) -> DataFrame:
    """(page_id, pos, end): the matching close of every non-void element open.

    Within (page, tag name, nesting level) an open is directly followed by its
    close, so the match is a ``lead`` over that window: linear, no pairing of
    opens with closes. ``end`` is NULL for unclosed elements.
    """
    opens = F.col("is_tag") & ~F.col("is_close")
    by_name = Window.partitionBy("page_id", "name").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = (tokens.filter(F.col("is_tag") & ~F.col("name").isin(*VOID))
         .withColumn("_d", F.sum(F.when(opens, 1).otherwise(-1)).over(by_name)))
    t = t.withColumn("_lvl", F.when(opens, F.col("_d")).otherwise(F.col("_d") + 1))
    w = Window.partitionBy("page_id", "name", "_lvl").orderBy("pos")
    return (t.withColumn("_np", F.lead("pos").over(w)).withColumn("_nc", F.lead("is_close").over(w))
            .filter(opens).select("page_id", "pos", F.when(F.col("_nc"), F.col("_np")).alias("end")))
