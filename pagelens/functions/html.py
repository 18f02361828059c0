"""Row-local HTML functions built on Java regexes (no DOM, no Python).

These follow the reference's own regex-based extractors, so they run on raw
html with entities kept. DOM-style block extraction lives in
``pagelens.operators.blocks`` (token rows + windows).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.common import col, falsy, php_trim, byte_len
from pagelens.functions.text import TAG_RE, strip_tags, word_count
from pagelens.functions.url import url_host

IMG_RE = r"(?i)<img[^>]+>"
ANCHOR_RE = r'(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>'
JSONLD_RE = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
HEADING_OPEN_RE = r"(?i)<h[1-6]"
# Marked section: name then body up to the END marker of the same name.
MARKER_RE = r"(?s)<!-- ECHO5:START (\w+) -->(.*?)<!-- ECHO5:END \1 -->"


def heading_re(level: int) -> str:
    return rf"(?is)<h{level}[^>]*>(.*?)</h{level}>"


def headings(html, level: int) -> Column:
    """Tag-stripped texts of every ``<hN>`` element, in document order."""
    h = col(html)
    opened = F.contains(h, F.lit(f"<h{level}")) | F.contains(h, F.lit(f"<H{level}"))  # most pages lack some levels: no pattern for them
    found = F.when(~opened, F.array().cast("array<string>")).otherwise(F.regexp_extract_all(h, F.lit(heading_re(level)), 1))
    return F.transform(found, strip_tags)


def heading_map(html) -> Column:
    """MAP h1..h6 -> array of texts; all six keys are always present."""
    args = []
    for i in range(1, 7):
        args += [F.lit(f"h{i}"), headings(html, i)]
    return F.create_map(*args)


def heading_count(html) -> Column:
    """Number of ``<h1``..``<h6`` openings (case-insensitive)."""
    return F.regexp_count(col(html), F.lit(HEADING_OPEN_RE)).cast("bigint")


def content_stats(html) -> Column:
    """html_length (bytes), word_count of the html with tags removed, heading_count.

    Validation strips tags only (script/style text stays, no trim), unlike the
    export's ``strip_tags``.
    """
    h = col(html)
    return F.struct(
        byte_len(h).cast("bigint").alias("html_length"),
        word_count(F.regexp_replace(h, TAG_RE, "")).alias("word_count"),
        heading_count(h).alias("heading_count"),
    )


def _attr(tag: Column, name: str, allow_empty: bool) -> Column:
    q = "*" if allow_empty else "+"
    return F.regexp_extract(tag, rf'(?i){name}="([^"]{q})"', 1)


def images(html) -> Column:
    """Every ``<img>`` tag as a struct; double-quoted attributes only.

    The first ``src="`` in the tag wins, so ``data-src`` before ``src`` is taken.
    """
    def one(tag):
        alt = _attr(tag, "alt", True)
        loading = _attr(tag, "loading", False)
        return F.struct(
            _attr(tag, "src", False).alias("src"),
            alt.alias("alt"),
            _attr(tag, "width", False).alias("width"),
            _attr(tag, "height", False).alias("height"),
            loading.alias("loading"),
            (~falsy(alt)).alias("has_alt"),
            (loading == F.lit("lazy")).alias("has_lazy_loading"),
        )
    return F.transform(F.regexp_extract_all(col(html), F.lit(IMG_RE), 0), one)


def links(html, site_host) -> Column:
    """Anchors with ``href="..."`` as (pos, url, text, kind) structs.

    Anchors whose href starts with ``#`` or ``javascript:`` are skipped; a link
    is internal when it has no host or its host equals ``site_host``.
    """
    h = col(html)
    hrefs = F.regexp_extract_all(h, F.lit(ANCHOR_RE), 1)
    texts = F.regexp_extract_all(h, F.lit(ANCHOR_RE), 2)
    zipped = F.arrays_zip(hrefs.alias("url"), texts.alias("raw"))

    def shape(z, i):
        host = url_host(z["url"])
        internal = host.isin(F.lit(""), col(site_host))
        return F.struct(
            (i + 1).alias("pos"),
            z["url"].alias("url"),
            strip_tags(z["raw"]).alias("text"),
            F.when(internal, F.lit("internal")).otherwise(F.lit("external")).alias("kind"),
        )

    keep = lambda s: ~(s["url"].startswith("#") | s["url"].startswith("javascript:"))
    return F.filter(F.transform(zipped, shape), keep)


def jsonld_blocks(html) -> Column:
    """Trimmed bodies of ``application/ld+json`` scripts, in document order."""
    return F.transform(F.regexp_extract_all(col(html), F.lit(JSONLD_RE), 1), php_trim)


# JSON texts that decode to a PHP-falsy value (dropped by the reference).
FALSY_JSON = ("{}", "[]", "false", "0", "0.0", '""', '"0"', "null")


def jsonld_valid(text) -> Column:
    """Decodes as JSON to a non-empty value."""
    v = F.try_parse_json(col(text))
    return v.isNotNull() & ~F.to_json(v).isin(*FALSY_JSON)


def section_markers(html) -> Column:
    """Names of ``<!-- ECHO5:START name -->...<!-- ECHO5:END name -->`` sections."""
    return F.regexp_extract_all(col(html), F.lit(MARKER_RE), 1)


def has_h1(html) -> Column:
    return F.contains(col(html), F.lit("<h1"))
