"""Text functions: tag stripping, word counts, excerpts, block text keys.

All are JVM-side Spark expressions (regexes run as Java regex), so they stay
inside whole-stage codegen and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelens.functions.common import col, php_trim

# script/style elements with their bodies (one pass; the back-reference keeps
# <script>...</style> from pairing up across element kinds).
SCRIPT_STYLE_RE = r"(?is)<(script|style)[^>]*?>.*?</\1>"
# A tag: '<' not followed by whitespace, up to the next '>' ("a < b" is text).
TAG_RE = r"<(?:[^\s>][^>]*)?>"
# ASCII word characters of str_word_count(): letters, apostrophe, hyphen.
WORD_RE = r"[A-Za-z'-]+"
UNICODE_WORD_RE = r"[\p{L}'-]+"
WS_SPLIT_RE = r"[\n\r\t ]+"


def strip_tags(c) -> Column:
    """Remove script/style bodies, then every tag, then trim (no entity decoding)."""
    no_code = F.regexp_replace(col(c), SCRIPT_STYLE_RE, "")
    return php_trim(F.regexp_replace(no_code, TAG_RE, ""))


def word_count(c, unicode: bool = False) -> Column:
    """``str_word_count`` semantics: runs of letters, ``'`` and ``-``.

    One leading ``'``/``-`` and one trailing ``-`` of the whole string are not
    part of any word. Default is the ASCII rule (accented letters split words);
    ``unicode=True`` counts any letter.
    """
    t = F.regexp_replace(F.regexp_replace(col(c), r"^['-]", ""), r"-\z", "")
    n = F.regexp_count(t, F.lit(UNICODE_WORD_RE if unicode else WORD_RE))
    return F.coalesce(n, F.lit(0)).cast("bigint")


def reading_time(words) -> Column:
    """Minutes at 200 words per minute, rounded up; 0 words -> 0."""
    return F.ceil(col(words) / F.lit(200)).cast("bigint")


def words(c) -> Column:
    """Non-empty whitespace-separated pieces of ``c``."""
    return F.filter(F.split(col(c), WS_SPLIT_RE), lambda w: w != F.lit(""))


def trim_words(c, n: int = 30, more: str = "&hellip;") -> Column:
    """``wp_trim_words``: first ``n`` words of the tag-stripped text, ``more`` if cut."""
    return first_words(strip_tags(c), n, more)


def first_words(text, n: int = 30, more: str = "&hellip;") -> Column:
    """First ``n`` words of a stripped (trimmed) text, ``more`` if cut; what follows them stays one piece."""
    def cut(w):
        head = F.array_join(F.slice(w, 1, n), " ")
        return F.when(F.size(w) > n, F.concat(head, F.lit(more))).otherwise(head)

    # the pieces are made once and handed on as a value
    pieces = F.transform(F.array(F.split(col(text), WS_SPLIT_RE, n + 1)), lambda p: F.filter(p, lambda w: w != F.lit("")))
    return F.transform(pieces, cut)[0]


def excerpt(own_excerpt, text, n: int = 30, stripped=None) -> Column:
    """Own excerpt when set, else the first ``n`` words of the text; ``stripped`` is the text without tags where there is one."""
    own = col(own_excerpt)
    return F.when(own.isNotNull() & (own != ""), own).otherwise(trim_words(text, n) if stripped is None else first_words(stripped, n))


def normalize_text(c) -> Column:
    """Duplicate key of a block: drop all but ``[a-z0-9]`` (capitals are lost)."""
    return F.regexp_replace(col(c), "[^a-z0-9]+", "")


def collapse_ws(c) -> Column:
    return F.regexp_replace(col(c), r"\s+", " ")


# The reference's skip phrases for main-content blocks (in its order).
BOILERPLATE_PHRASES = (
    "hours of operation", "our location", "connect with us",
    "our regular schedule", "find us on the map", "contact us",
    "navigation", "menu", "copyright", "all rights reserved",
    "privacy policy", "terms of service", "follow us",
)


def is_boilerplate(c) -> Column:
    """True when the lower-cased text contains any boilerplate phrase."""
    def any_of(low):
        hit = F.lit(False)
        for p in BOILERPLATE_PHRASES:
            hit = hit | F.contains(low, F.lit(p))
        return hit

    return F.exists(F.array(F.lower(col(c))), any_of)  # lower-cased once for all phrases


def has_blocks(c) -> Column:
    """Content written with the block editor carries ``<!-- wp:`` comments."""
    return F.contains(col(c), F.lit("<!-- wp:"))
