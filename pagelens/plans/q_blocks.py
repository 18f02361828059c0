"""M3 queries: html tokens, main-content scope, node text, content blocks."""

from __future__ import annotations

import html.entities

from pyspark.sql import functions as F

from pagelens.operators import blocks as B
from pagelens.plans.registry import query


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


WS = "[ \\t\\n\\r\\f\\x0B]"


def _decode(x: str) -> str:
    """Named and numeric character references decoded piece by piece (names from the HTML standard's table)."""
    q = lambda v: "'" + v.replace("'", "''") + "'"
    named = {k: v for k, v in html.entities.html5.items() if k.endswith(";")}
    table = f"MAP {{{', '.join(f'{q(k)}: {q(v)}' for k, v in named.items())}}}"
    name = "regexp_extract(p, '^[A-Za-z][A-Za-z0-9]*;', 0)"
    dec = "regexp_extract(p, '^#([0-9]+);', 1)"
    hexa = "regexp_extract(p, '^#[xX]([0-9A-Fa-f]+);', 1)"
    one = (f"CASE WHEN {name} <> '' AND len(map_extract({table}, {name})) > 0 THEN map_extract({table}, {name})[1] || substr(p, length({name}) + 1) "
           f"WHEN {dec} <> '' THEN chr(CAST({dec} AS INTEGER)) || regexp_replace(p, '^#[0-9]+;', '') "
           f"WHEN {hexa} <> '' THEN chr(CAST('0x' || {hexa} AS INTEGER)) || regexp_replace(p, '^#[xX][0-9A-Fa-f]+;', '') ELSE '&' || p END")
    return (f"CASE WHEN contains({x}, '&') THEN string_split({x}, '&')[1] || "
            f"array_to_string(list_transform(string_split({x}, '&')[2:], lambda p: {one}), '') ELSE {x} END")


def tokens_sql(src: str) -> str:
    """DuckDB: the same tokenisation (two passes instead of a back-reference)."""
    clean = "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
    clean = f"regexp_replace({clean}, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g')"
    clean = f"regexp_replace({clean}, '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g')"
    return f"""
pc AS (SELECT page_id, {clean} AS h FROM {src}),
pz AS (SELECT page_id, unnest(string_split(h, '<')) AS piece,
         CAST(generate_subscripts(string_split(h, '<'), 1) - 1 AS INTEGER) AS pos FROM pc),
tk AS (
  SELECT page_id, pos,
    CASE WHEN e THEN lower(regexp_extract(piece, '^/?([A-Za-z][A-Za-z0-9]*)', 1)) ELSE '' END AS name,
    e AND starts_with(piece, '/') AS is_close, e AS is_tag,
    CASE WHEN e THEN regexp_extract(piece, '(?s)^/?[A-Za-z][A-Za-z0-9]*([^>]*)', 1) ELSE '' END AS attrs,
    CASE WHEN e OR d THEN regexp_extract(piece, '(?s)^[^>]*>(.*)$', 1)
         WHEN pos = 0 THEN piece ELSE '<' || piece END AS tail
  FROM (SELECT *, pos > 0 AND regexp_matches(piece, '^/?[A-Za-z]') AS e,
               pos > 0 AND regexp_matches(piece, '^[!?]') AS d FROM pz))"""


def _cls(frag: str) -> str:
    return (f"contains(regexp_extract(attrs, '(?is)\\bclass\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s>]+))', 0),"
            f" '{frag}')")


def scope_sql() -> str:
    tests = ["name = 'main'",
             "regexp_matches(attrs, '(?i)\\brole\\s*=\\s*(?:\"main\"|''main''|main(?:[\\s/>]|$))')",
             "name = 'article'"] + [_cls(f) for f in B.MAIN_SELECTORS[3:]]
    prio = "CASE " + " ".join(f"WHEN {t} THEN {i + 1}" for i, t in enumerate(tests)) + " END"
    return f"""
tp AS (
  SELECT *, CASE WHEN is_tag AND NOT is_close THEN {prio} END AS prio,
    sum(CASE WHEN is_tag AND NOT is_close THEN 1 WHEN is_close THEN -1 ELSE 0 END)
      OVER (PARTITION BY page_id, name ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS depth
  FROM tk),
sp AS (SELECT page_id, min(prio) AS sprio FROM tp GROUP BY page_id),
so AS (SELECT tp.page_id, min(tp.pos) AS spos FROM tp JOIN sp ON tp.page_id = sp.page_id AND tp.prio = sp.sprio
       GROUP BY tp.page_id),
sx AS (SELECT so.page_id, so.spos, tp.name AS sname, tp.depth AS sdepth, tp.prio AS sprio
       FROM so JOIN tp ON tp.page_id = so.page_id AND tp.pos = so.spos),
se AS (SELECT sx.page_id, min(tp.pos) AS send FROM sx JOIN tp ON tp.page_id = sx.page_id
       AND tp.is_close AND tp.name = sx.sname AND tp.pos > sx.spos AND tp.depth = sx.sdepth - 1 GROUP BY sx.page_id),
scoped AS (
  SELECT tk.*, coalesce(sx.spos, -1) AS scope_start, coalesce(se.send, {B.BIG}) AS scope_end, sx.sprio AS scope_selector
  FROM tk LEFT JOIN sx ON tk.page_id = sx.page_id LEFT JOIN se ON tk.page_id = se.page_id)"""


def blocks_sql(src: str, main: bool, boilerplate: bool, stage: str = "capped", cap: int = 2**31 - 1) -> str:
    toks = "scoped" if main else "tk"
    opens = "is_tag AND NOT is_close"
    nic = f"(is_close AND name NOT IN {_in(B.INLINE)})"
    term_p = f"(({opens} AND name IN {_in(B.P_CLOSERS)}) OR {nic})"
    term_h = f"(({opens} AND name IN {_in(B.BLOCK_TAGS)}) OR {nic})"
    is_block = f"({opens} AND name IN {_in(B.BLOCK_TAGS)})"
    back = "OVER (PARTITION BY page_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    run = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    scope_filter = "AND bstart > scope_start AND bstart < scope_end" if main else ""
    piece = _decode("tail")
    piece = f"CASE WHEN {opens} AND name NOT IN {_in(B.VOID)} THEN regexp_replace({piece}, '^{WS}+', '') ELSE {piece} END"
    piece = f"CASE WHEN next_close THEN regexp_replace({piece}, '{WS}+$', '') ELSE {piece} END"
    keep = ("text IS NOT NULL AND text <> '' AND text <> '0' AND "
            "strlen(text) >= CASE WHEN tag = 'p' THEN 20 ELSE 10 END")
    if boilerplate:
        keep += (" AND NOT regexp_matches(lower(text), '" + "|".join(
            __import__("pagelens.functions.text", fromlist=["x"]).BOILERPLATE_PHRASES) + "')")
    return f"""WITH {tokens_sql(src)},{scope_sql() if main else ''}{',' if main else ''}
t1 AS (
  SELECT *, last_value(CASE WHEN {term_p} THEN pos END IGNORE NULLS) {back} AS next_tp,
    last_value(CASE WHEN {term_h} THEN pos END IGNORE NULLS) {back} AS next_th,
    lead(is_close, 1, false) OVER (PARTITION BY page_id ORDER BY pos) AS next_close
  FROM {toks}),
t2 AS (
  SELECT *,
    last_value(CASE WHEN {is_block} THEN pos END IGNORE NULLS) {run} AS bstart,
    last_value(CASE WHEN {is_block} THEN coalesce(CASE WHEN name = 'p' THEN next_tp ELSE next_th END, {B.BIG}) END IGNORE NULLS) {run} AS bend,
    last_value(CASE WHEN {is_block} THEN name END IGNORE NULLS) {run} AS btag
  FROM t1),
raw AS (
  SELECT page_id, bstart AS pos, btag AS tag,
    regexp_replace(regexp_replace(string_agg({piece}, '' ORDER BY pos), '^{WS}+|{WS}+$', '', 'g'), '{WS}+', ' ', 'g') AS text
  FROM t2 WHERE bstart IS NOT NULL AND pos < bend {scope_filter}
  GROUP BY page_id, bstart, btag),
kept AS (SELECT * FROM raw WHERE {keep}),
dedup AS (
  SELECT page_id, pos, tag, text FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id, regexp_replace(text, '[^a-z0-9]+', '', 'g') ORDER BY pos) AS rn
    FROM kept) WHERE rn = 1),
capped AS (
  SELECT page_id, CAST(rn AS INTEGER) AS pos, tag, text FROM (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM dedup) WHERE rn <= {cap})
SELECT * FROM {stage}"""


@query("html_tokens", oracle=f"""WITH {tokens_sql('pages')}
SELECT page_id, pos, name, is_close FROM tk WHERE is_tag""")
def html_tokens(t):
    """Element tokens (page, pos, name, open/close) of every page."""
    return B.html_tokens(t.pages).filter("is_tag").select("page_id", "pos", "name", "is_close")


@query("main_content_scope", oracle=f"""WITH {tokens_sql('pages')},{scope_sql()}
SELECT DISTINCT page_id, scope_start, scope_end, scope_selector FROM scoped""")
def main_content_scope(t):
    """Main content span per page: first matching selector, its matching close."""
    s = B.main_content_scope(B.html_tokens(t.pages))
    return s.select("page_id", "scope_start", "scope_end", "scope_selector").distinct()


@query("node_text", oracle=blocks_sql("pages", main=False, boilerplate=False, stage="raw").replace(
    "SELECT * FROM raw", "SELECT page_id, pos, tag, text FROM raw"))
def node_text(t):
    """Text of every h1-h6/p element (nested elements trimmed, whitespace collapsed)."""
    return B.block_rows(B.html_tokens(t.pages))


@query("content_blocks_main", oracle=blocks_sql("pages", main=True, boilerplate=True))
def content_blocks_main(t):
    """Main-content blocks of every rendered page: filters, dedup."""
    return B.content_blocks_main(t.pages)


@query("content_blocks_main_enriched", oracle=blocks_sql("enriched_pages", main=True, boilerplate=True),
       views=("enriched_pages",))
def content_blocks_main_enriched(t):
    """Main-content blocks over pages with h2/h3, boilerplate phrase and markers."""
    return B.content_blocks_main(t.enriched_pages)


@query("content_blocks_html", oracle=blocks_sql("posts", main=False, boilerplate=False).replace(
    "FROM posts)", "FROM (SELECT id AS page_id, post_content AS html FROM posts))"), views=("posts",))
def content_blocks_html(t):
    """Blocks of each post's whole content fragment (no scope, no phrase filter)."""
    return B.content_blocks_html(t.posts, id_col="id", html_col="post_content")


@query("block_dedup", oracle=blocks_sql("pages", main=False, boilerplate=False, stage="dedup"))
def block_dedup(t):
    """Blocks after removing later duplicates of the same normalized text."""
    raw = B.block_filters(B.block_rows(B.html_tokens(t.pages)), False)
    return B.block_dedup(raw)


@query("block_cap", oracle=blocks_sql("documents", main=False, boilerplate=False, cap=100).replace(
    "FROM documents)",
    "FROM (SELECT doc_id AS page_id, '<p>' || replace(text, chr(10), '</p><p>') || '</p>' AS html FROM documents))"))
def block_cap(t):
    """First 100 blocks per document (documents as html fragments: many exceed 100)."""
    docs = t.documents.select(F.col("doc_id").alias("page_id"),
                              F.concat(F.lit("<p>"), F.regexp_replace("text", r"\n", "</p><p>"), F.lit("</p>")).alias("html"))
    return B.content_blocks_html(docs, cap=100)
