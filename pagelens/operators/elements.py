"""The element tree of a page as one fold over its token array: no window, no shuffle, no parser.

A page's html is cut at every ``<``; the pieces become an array of tokens in the row.
``aggregate`` walks them with a stack of the elements that are open and writes a node
when an element ends, so each node has its span of tokens, its parent and, for widgets, its
type. Rules: an end tag closes the innermost open element of its name and all above it, and is ignored
where there is none; void elements end at once; a start tag first ends up to two
innermost elements that it closes by implication (a paragraph before a block, a heading
before a heading or paragraph, list items, cells and the like before their own kind); what is
open at the end of the page ends there. ``html`` and ``body`` tags are not elements.

The array of nodes grows in chunks of CHUNK tokens, so a long page does not copy it at every token.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.operators.blocks import HEADINGS, P_CLOSERS, VOID, clean_html, decode_entities

#: Tokens folded before their nodes are appended to the page's.
CHUNK = 256
# Elements that a start tag of the second group ends when they are innermost.
IMPLIED_ENDS = (
    (("p",), P_CLOSERS), (HEADINGS, HEADINGS + ("p",)), (("li",), ("li",)), (("dt", "dd"), ("dt", "dd")),
    (("td", "th"), ("td", "th", "tr")), (("tr",), ("tr",)), (("option",), ("option",)),
)
PHP_TRIM = " \t\n\r\0\x0b"

_ENTRY = "struct<p:int,n:string,u:int,w:boolean,t:string,c:int,k:int,s:boolean>"
_NODE = "struct<p:int,e:int,u:int,t:string,k:int,s:boolean>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def attr(attrs: Column, name: str) -> Column:
    """Value of a quoted attribute; empty without it."""
    value = F.regexp_extract(attrs, rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*["']([^"']*)["']""", 1)
    return F.when(F.contains(attrs, F.lit("=")), value).when(attrs.isNotNull(), "")


def falsy(c: Column) -> Column:
    return c.isNull() | c.isin("", "0")


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(PHP_TRIM))


def tokens(html: Column) -> Column:
    """Array of (name, close, attrs, tail), a token for each piece between ``<`` signs; name is '' for text and declarations."""
    def token(x):
        element, slash, head = x["name"] != "", x["head"].startswith("/"), x["head"]
        declared = x["tag"] & (head.startswith("!") | head.startswith("?"))
        return F.struct(
            F.lower(x["name"]).alias("name"), (element & slash).alias("close"),
            F.when(element, F.substr(head, F.length(x["name"]) + F.when(slash, 2).otherwise(1))).otherwise("").alias("attrs"),
            F.when(element | declared, F.substr(x["piece"], F.length(head) + 2)).when(~x["tag"], x["piece"]).otherwise(F.concat(F.lit("<"), x["piece"])).alias("tail"))

    # step by step, so that each piece is looked at up to its first ">" by one pattern
    pieces = F.transform(F.split(clean_html(html), "<"), lambda piece, i: F.struct((i > 0).alias("tag"), piece.alias("piece"), F.substring_index(piece, ">", 1).alias("head")))
    named = F.transform(pieces, lambda x: F.struct(x["tag"], x["piece"], x["head"], F.when(x["tag"], F.regexp_extract(x["head"], r"^/?([A-Za-z][A-Za-z0-9]*)", 1)).otherwise("").alias("name")))
    return F.transform(named, token)


def _ends(top: Column, new: Column) -> Column:
    out = F.lit(False)
    for olds, news in IMPLIED_ENDS:
        out = out | (top.isin(*olds) & new.isin(*news))
    return F.coalesce(out, F.lit(False))


def _popped(entries: Column, end: Column) -> Column:
    return F.transform(entries, lambda x: F.struct(x["p"], end.alias("e"), x["u"], x["t"], x["k"], x["s"]))


def _hollow(entries: Column, n: Column, end: Column) -> Column:
    """The innermost ended element of no widget kind in which no widget has begun, as an array of at most one node."""
    bare = F.filter(entries, lambda x: ~x["w"] & x["t"].isNull() & (x["c"] == n))
    return F.transform(F.slice(F.reverse(bare), 1, 1), lambda x: F.struct(x["p"], end.alias("e"), x["u"], F.lit("hollow").alias("t"), x["k"], x["s"]))


def nodes(toks: Column, widget, plain: tuple[str, ...], sections: tuple[str, ...]) -> Column:
    """Array of (p, e, u, t, k, s), by p: every element's first token, the token after its last, its parent's first token (-1 without).

    ``widget(token)`` names the kind of an element that is a widget of its own (null: none); ``t`` is
    that name where the element stands in no other widget, ``text`` for a text outside all widgets, and ``hollow``
    (beside the element's own node) for an element, not of the names in ``plain``, in which nothing else is a widget.
    ``k`` counts the outermost elements named in ``sections`` so far; ``s`` tells whether the node is inside one.
    """
    n_tokens = F.size(toks)
    marked = F.transform(toks, lambda t, i: F.struct(
        i.alias("i"), F.when(t["name"].isin("html", "body"), "").otherwise(t["name"]).alias("name"), t["close"].alias("close"),
        F.when(~t["close"] & (t["name"] != ""), widget(t)).alias("t"), (F.trim(t["tail"]) != "").alias("text")))
    none = F.array().cast(f"array<{_NODE}>")
    start = F.struct(F.array().cast(f"array<{_ENTRY}>").alias("open"), F.lit(0).alias("n"), F.lit(0).alias("k"), none.alias("out"))

    def step(s: Column, t: Column) -> Column:
        stack = s["open"]
        tag = t["name"] != ""
        back = F.array_position(F.reverse(F.transform(stack, lambda x: x["n"])), t["name"]).cast("int")
        top, below = F.try_element_at(stack, F.lit(-1))["n"], F.try_element_at(stack, F.lit(-2))["n"]
        ends = F.when(_ends(top, t["name"]), F.when(_ends(below, t["name"]), 2).otherwise(1)).otherwise(0)
        keep = F.size(stack) - F.when(~tag, 0).when(t["close"], back).otherwise(ends)

        def popped(c: Column) -> Column:
            gone = F.slice(stack, c["keep"] + 1, F.greatest(F.size(stack) - c["keep"], F.lit(0)))
            return let(F.struct(F.slice(stack, F.lit(1), c["keep"]).alias("stack"), gone.alias("gone")), opened)

        def opened(c: Column) -> Column:
            up = F.try_element_at(c["stack"], F.lit(-1))
            widgets = F.size(F.filter(c["gone"], lambda x: x["t"].isNotNull()))
            hollow = _hollow(c["gone"], s["n"] + widgets, t["i"])
            n = s["n"] + widgets + F.size(hollow)
            opens, inside = tag & ~t["close"], F.coalesce(up["w"], F.lit(False))
            k = s["k"] + F.when(opens & (F.size(c["stack"]) == 0) & t["name"].isin(*sections), 1).otherwise(0)
            in_section = F.when(F.size(c["stack"]) > 0, F.coalesce(F.get(c["stack"], F.lit(0))["s"], F.lit(False))).otherwise(opens & t["name"].isin(*sections))
            own = F.when(~inside, t["t"])
            entry = F.struct(t["i"].alias("p"), t["name"].alias("n"), F.coalesce(up["p"], F.lit(-1)).alias("u"), (inside | t["t"].isNotNull()).alias("w"), own.alias("t"),
                             F.when(t["name"].isin(*plain), -1).otherwise(n).alias("c"), k.alias("k"), in_section.alias("s"))
            return let(F.struct(c["stack"].alias("stack"), F.concat(_popped(c["gone"], t["i"]), hollow).alias("out"), n.alias("n"), k.alias("k"),
                                entry.alias("entry"), opens.alias("opens"), (opens & t["name"].isin(*VOID)).alias("void")), ended)

        def ended(c: Column) -> Column:
            entry = F.array(c["entry"])
            lone = F.when(c["void"], F.concat(_popped(entry, t["i"] + 1), _hollow(entry, c["n"], t["i"] + 1))).otherwise(none)
            stack2 = F.when(c["opens"] & ~c["void"], F.concat(c["stack"], entry)).otherwise(c["stack"])
            return let(F.struct(stack2.alias("stack"), F.concat(c["out"], lone).alias("out"),
                                (c["n"] + F.when(c["void"] & ~F.try_element_at(c["stack"], F.lit(-1))["w"].eqNullSafe(F.lit(True)), 1).otherwise(0)).alias("n"), c["k"].alias("k")), written)

        def written(c: Column) -> Column:
            up = F.try_element_at(c["stack"], F.lit(-1))
            loose = t["text"] & ~F.coalesce(up["w"], F.lit(False))
            text = F.struct(t["i"].alias("p"), (t["i"] + 1).alias("e"), F.coalesce(up["p"], F.lit(-1)).alias("u"), F.lit("text").alias("t"), c["k"].alias("k"),
                            F.coalesce(F.get(c["stack"], F.lit(0))["s"], F.lit(False)).alias("s"))
            return F.struct(c["stack"].alias("open"), (c["n"] + F.when(loose, 1).otherwise(0)).alias("n"), c["k"].alias("k"),
                            F.when(loose, F.concat(c["out"], F.array(text))).otherwise(c["out"]).alias("out"))

        return let(let(F.struct(keep.alias("keep")), popped), lambda r: F.struct(r["open"], r["n"], r["k"], F.concat(s["out"], r["out"]).alias("out")))

    def chunk(s: Column, part: Column) -> Column:
        folded = F.aggregate(part, F.struct(s["open"], s["n"], s["k"], none.alias("out")), step)
        return let(folded, lambda r: F.struct(r["open"], r["n"], r["k"], F.concat(s["out"], r["out"]).alias("out")))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(marked) - 1) / CHUNK).cast("int")), lambda c: F.slice(marked, c * CHUNK + 1, CHUNK))
    done = F.aggregate(parts, start, chunk)
    out = let(done, lambda r: F.concat(r["out"], _popped(r["open"], n_tokens), _hollow(r["open"], r["n"] + F.size(F.filter(r["open"], lambda x: x["t"].isNotNull())), n_tokens)))
    return F.array_sort(out)


def _span(toks: Column, first: Column, after: Column) -> Column:
    return F.slice(toks, first + 1, F.greatest(after - first, F.lit(0)))


def text_content(toks: Column, p: Column, e: Column) -> Column:
    """All text of an element, character references decoded; a void element has none."""
    text = F.array_join(F.transform(_span(toks, p, e), lambda t: decode_entities(t["tail"])), "")
    return F.when(F.get(toks, p)["name"].isin(*VOID), "").otherwise(text)


def markup(toks: Column, first: Column, after: Column) -> Column:
    """The tokens written as html again, tag names in lower case."""
    tag = lambda t: F.when(t["name"] == "", "").otherwise(F.concat(F.when(t["close"], "</").otherwise("<"), t["name"], t["attrs"], F.lit(">")))
    return F.array_join(F.transform(_span(toks, first, after), lambda t: F.concat(tag(t), t["tail"])), "")


def inner_markup(toks: Column, p: Column, e: Column) -> Column:
    return F.concat(F.get(toks, p)["tail"], markup(toks, p + 1, e))


def outer_markup(toks: Column, p: Column, e: Column) -> Column:
    """An element with its tags; its end tag is written even where the page leaves it out."""
    at = F.get(toks, p)
    opened = F.concat(F.lit("<"), at["name"], at["attrs"], F.lit(">"))
    return F.when(at["name"].isin(*VOID), opened).otherwise(F.concat(opened, inner_markup(toks, p, e), F.lit("</"), at["name"], F.lit(">")))
