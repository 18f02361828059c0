"""HTML to builder widgets: test pages, queries and their SQL (the fold as a recursive query, a token a step)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import widgets as W
from pagelens.plans.q_blocks import _decode, tokens_sql
from pagelens.plans.registry import query

TYPES = "'icon-box', 'icon-list', 'counter', 'testimonial', 'call-to-action', 'accordion', 'star-rating', 'button'"

#: Documents as pages that hold every widget kind, one special widget of each type in turn, item lists of every pattern.
PAGES_SQL = f"""
SELECT doc_id AS page_id, concat(
  '<section class="py-8 bg-gray-', CAST((doc_id % 10) * 100 AS VARCHAR), '"><h2 class="text-center">Section <i>', CAST(doc_id AS VARCHAR), '</i></h2><p>', text,
  ' <a href="/z">link</a> &amp; <em>more</em></p><p> </p><img src="/w.png" alt="w"><img alt="none"><hr></section>between<header class="bg-slate-50"><ul class="l"><li>one <b>two</b></li><li>three</li></ul>',
  '<blockquote>said <i>so</i></blockquote><iframe src="https://v.example.com/', CAST(doc_id AS VARCHAR), '"></iframe></header>',
  '<div class="grid"><a class="btn" href="/x">Go <b>now</b></a><a href="https://o.example.com">out <b>there</b></a><table><tr><td>1<td>2</table>text &eacute; here<nav><br></nav><pre></pre></div>',
  '<div data-elementor="', (array[{TYPES}])[doc_id % 8 + 1], '" data-icon="', CASE WHEN doc_id % 3 = 0 THEN 'wrench' WHEN doc_id % 3 = 1 THEN 'fa fa-x' ELSE '' END,
  '" data-number="', CAST(doc_id % 100 AS VARCHAR), ' %" data-prefix="~" data-suffix="%" data-name="', CASE WHEN doc_id % 2 = 0 THEN 'Ann & Co' ELSE '' END,
  '" data-company="C" data-rating="', CASE WHEN doc_id % 4 = 0 THEN '4.5' ELSE '' END, '" data-image="/f.png" href="/own">', CASE WHEN doc_id % 5 = 0 THEN '' ELSE '<h3>Widget <u>title</u></h3>' END, '<p>', text,
  '</p><p>More <em>text</em> &eacute;</p><strong>bold</strong><a href="/first">First</a><a href="/cta">Call <b>us</b></a><div><div data-elementor="button">inner</div></div></div>',
  '<article><ul data-elementor="icon-list" data-icon="', CASE WHEN doc_id % 2 = 0 THEN 'star' ELSE 'nope' END, '"><li data-icon="arrow-right">One <b>bold</b> 1<li>Two</li><li> </li><li data-icon="nope">0</li><li data-icon="odd">Last</li></ul>',
  '<div data-elementor="accordion"><details><summary>Q1 <i>x</i></summary><p>A <b>bold</b> 1</p><p>more</p></details><div><h3>Q', CAST(doc_id AS VARCHAR),
  '</h3><p>A2</p><em>not said</em><span>s</span></div><div><p>no question</p></div><details>loose</details></div>',
  '<div data-elementor="accordion"><h3>No</h3><p>pairs</p></div></article><footer></footer><main><div data-elementor="none"><button data-elementor="button" href="/b"> Press </button></div></main>') AS html
FROM documents"""


def widget_pages(t):
    text = PAGES_SQL.replace(f"(array[{TYPES}])[doc_id % 8 + 1]", f"element_at(array({TYPES}), CAST(doc_id % 8 + 1 AS INT))").replace("VARCHAR", "STRING").replace("FROM documents", "FROM {documents}")
    return t.spark.sql(text, documents=t.documents)


def _attr(name: str, of: str = "attrs") -> str:
    return f"""regexp_extract({of}, '(?is)(?:^|[\\s"''/]){name}\\s*=\\s*["'']([^"'']*)["'']', 1)"""


def _trim(x: str) -> str:
    return f"trim({x}, chr(32) || chr(9) || chr(10) || chr(13) || chr(0) || chr(11))"


VOIDS = "'area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr'"
HEADS = "'h1', 'h2', 'h3', 'h4', 'h5', 'h6'"
ENDS_P = f"""'address', 'article', 'aside', 'blockquote', 'center', 'dd', 'details', 'dialog', 'dir', 'div', 'dl', 'dt', 'fieldset', 'figcaption', 'figure', 'footer', 'form',
  {HEADS}, 'header', 'hgroup', 'hr', 'li', 'listing', 'main', 'menu', 'nav', 'ol', 'p', 'pre', 'section', 'table', 'ul', 'xmp'"""
TOPS = "'section', 'header', 'footer', 'article', 'main'"
ELEMENT = "coalesce(t NOT IN ('text', 'hollow'), true)"


def _ends(top: str) -> str:
    return (f"coalesce(({top} = 'p' AND nm IN ({ENDS_P})) OR ({top} IN ({HEADS}) AND nm IN ({HEADS}, 'p')) OR ({top} = 'li' AND nm = 'li') OR ({top} IN ('dt', 'dd') AND nm IN ('dt', 'dd'))"
            f" OR ({top} IN ('td', 'th') AND nm IN ('td', 'th', 'tr')) OR ({top} = 'tr' AND nm = 'tr') OR ({top} = 'option' AND nm = 'option'), false)")


def nodes_sql() -> str:
    """src, tk, nd: the pages, their tokens and their nodes (page_id, p, e, u, t, k, s, name, attrs, txt, markup parts)."""
    kind = f"""CASE WHEN {_attr('data-elementor')} IN ({TYPES}) THEN {_attr('data-elementor')} WHEN name IN ('head', 'title') THEN 'skip' WHEN name IN ({HEADS}) THEN 'heading'
    WHEN name IN ('p', 'blockquote', 'ul', 'ol', 'span', 'strong', 'em', 'b', 'i') THEN 'text-editor' WHEN name = 'img' THEN 'image' WHEN name = 'hr' THEN 'divider'
    WHEN name = 'a' THEN CASE WHEN regexp_matches({_attr('class')}, 'btn|button') THEN 'button' ELSE 'text-editor' END
    WHEN name IN ('table', 'form', 'iframe', 'video', 'audio', 'canvas', 'svg') THEN 'html' END"""
    entry = "STRUCT(p INT, n VARCHAR, u INT, w BOOLEAN, t VARCHAR, c INT, k INT, s BOOLEAN)[]"
    node = "STRUCT(p INT, e INT, u INT, t VARCHAR, k INT, s BOOLEAN)"
    pack = lambda x, e, t=None: f"{{'p': {x}.p, 'e': {e}, 'u': {x}.u, 't': {t or x + '.t'}, 'k': {x}.k, 's': {x}.s}}::{node}"
    return f"""src AS ({PAGES_SQL}),{tokens_sql('src')},
m AS (SELECT page_id, pos AS i, CASE WHEN name IN ('html', 'body') THEN '' ELSE name END AS nm, is_close AS cl, CASE WHEN NOT is_close AND name <> '' THEN {kind} END AS kd, trim(tail) <> '' AS tx FROM tk
  UNION ALL SELECT page_id, max(pos) + 1, '#end', true, NULL, false FROM tk GROUP BY page_id),
f AS (
  SELECT page_id, -1 AS i, []::{entry} AS st, 0 AS n, 0 AS k, []::{node}[] AS o FROM src
  UNION ALL
  SELECT page_id, i, st3, n4 + CASE WHEN loose THEN 1 ELSE 0 END, k2,
    list_concat(list_concat(list_transform(gone, lambda x: {pack('x', 'i')}), CASE WHEN len(bare) > 0 THEN [{pack('bare[-1]', 'i', "'hollow'")}] ELSE [] END),
      list_concat(CASE WHEN void THEN [{pack('en', 'i + 1')}] ELSE [] END, list_concat(
        CASE WHEN void AND NOT en.w AND en.c = n3 THEN [{pack('en', 'i + 1', "'hollow'")}] ELSE [] END,
        CASE WHEN loose THEN [{{'p': i, 'e': i + 1, 'u': coalesce(st3[-1].p, -1), 't': 'text', 'k': k2, 's': coalesce(st3[1].s, false)}}::{node}] ELSE [] END)))
  FROM (SELECT *, n3 + CASE WHEN void AND NOT inside THEN 1 ELSE 0 END AS n4, CASE WHEN op AND NOT void THEN list_append(st2, en) ELSE st2 END AS st3,
      tx AND NOT coalesce(CASE WHEN op AND NOT void THEN en.w ELSE st2[-1].w END, false) AS loose
    FROM (SELECT *, op AND nm IN ({VOIDS}) AS void, {{'p': i, 'n': nm, 'u': coalesce(st2[-1].p, -1), 'w': inside OR kd IS NOT NULL, 't': CASE WHEN NOT inside THEN kd END,
        'c': CASE WHEN nm IN ('div', 'section', 'article', 'aside', 'main') THEN -1 ELSE n3 END, 'k': k2, 's': CASE WHEN len(st2) > 0 THEN st2[1].s ELSE op AND nm IN ({TOPS}) END}} AS en
      FROM (SELECT *, n + wd + CASE WHEN len(bare) > 0 THEN 1 ELSE 0 END AS n3, k + CASE WHEN op AND len(st2) = 0 AND nm IN ({TOPS}) THEN 1 ELSE 0 END AS k2, coalesce(st2[-1].w, false) AS inside
        FROM (SELECT *, list_filter(gone, lambda x: NOT x.w AND x.t IS NULL AND x.c = n + wd) AS bare
          FROM (SELECT *, st[1:keep] AS st2, st[keep + 1:] AS gone, len(list_filter(st[keep + 1:], lambda x: x.t IS NOT NULL)) AS wd
            FROM (SELECT m.*, f.st, f.n, f.k, m.nm <> '' AND NOT m.cl AS op, len(f.st) - CASE WHEN m.nm = '' THEN 0 WHEN m.nm = '#end' THEN len(f.st)
                WHEN m.cl THEN coalesce(list_position(list_reverse(list_transform(f.st, lambda x: x.n)), m.nm), 0)
                WHEN {_ends('f.st[-1].n')} THEN CASE WHEN {_ends('f.st[-2].n')} THEN 2 ELSE 1 END ELSE 0 END AS keep
              FROM f JOIN m ON m.page_id = f.page_id AND m.i = f.i + 1))))))),
n0 AS (SELECT page_id, unnest(o, recursive := true) FROM f),
n1 AS (SELECT n0.*, tk.name, tk.attrs, tk.tail FROM n0 JOIN tk ON tk.page_id = n0.page_id AND tk.pos = n0.p),
sp AS (SELECT n1.page_id, n1.p, n1.e, n1.t, string_agg({_decode('x.tail')}, '' ORDER BY x.pos) AS txt,
    coalesce(string_agg(CASE WHEN x.name = '' THEN '' ELSE CASE WHEN x.is_close THEN '</' ELSE '<' END || x.name || x.attrs || '>' END || x.tail, '' ORDER BY x.pos) FILTER (x.pos > n1.p), '') AS rest
  FROM n1 JOIN tk x ON x.page_id = n1.page_id AND x.pos >= n1.p AND x.pos < n1.e GROUP BY ALL),
nd AS (SELECT n1.*, CASE WHEN name IN ({VOIDS}) AND {ELEMENT.replace('t ', 'n1.t ')} THEN '' ELSE {_trim('sp.txt')} END AS txt, n1.tail || rest AS inn,
    '<' || name || attrs || '>' || CASE WHEN name IN ({VOIDS}) THEN '' ELSE n1.tail || rest || '</' || name || '>' END AS outr
  FROM n1 JOIN sp ON sp.page_id = n1.page_id AND sp.p = n1.p AND sp.e = n1.e AND sp.t IS NOT DISTINCT FROM n1.t)"""


WIDGETS_SQL = f"""WITH RECURSIVE {nodes_sql()},
ts AS (SELECT page_id, k, {_attr('class')} AS cls FROM nd WHERE u = -1 AND name IN ({TOPS}) AND {ELEMENT}),
w AS (SELECT nd.*, CASE WHEN t IN ('text', 'hollow') THEN 'text-editor' ELSE t END AS widgetType, CASE WHEN t <> 'text' THEN name END AS tag,
    CASE WHEN t = 'text' OR name IN ({HEADS}, 'p', 'a') OR t = 'button' THEN txt END AS text,
    CASE WHEN t = 'image' THEN {_attr('src')} END AS src, CASE WHEN t = 'image' THEN {_attr('alt')} END AS alt,
    CASE WHEN t IN ('image', 'button') THEN 'center' WHEN t = 'heading' AND contains({_attr('class')}, 'text-center') THEN 'center' WHEN t = 'heading' AND contains({_attr('class')}, 'text-right') THEN 'right' END AS align,
    CASE WHEN t = 'heading' THEN CASE name WHEN 'h1' THEN 'xl' WHEN 'h2' THEN 'large' WHEN 'h3' THEN 'medium' ELSE 'small' END END AS size,
    CASE WHEN t = 'button' THEN {_attr('href')} END AS link,
    CASE WHEN t = 'text' THEN {_trim('tail')} WHEN t IN ('html', 'hollow') THEN outr WHEN t = 'text-editor' THEN CASE WHEN name = 'p' THEN '<p>' || inn || '</p>'
      WHEN name = 'blockquote' THEN '<blockquote>' || inn || '</blockquote>' WHEN name IN ('span', 'strong', 'em', 'b', 'i') THEN '<p>' || outr || '</p>' ELSE outr END END AS content,
    2 * k + CASE WHEN s THEN 0 ELSE 1 END AS g
  FROM nd WHERE t IS NOT NULL AND t <> 'skip' AND NOT (t = 'image' AND {_attr('src')} = '') AND NOT (t = 'text-editor' AND name = 'p' AND {_trim('inn')} IN ('', '0'))),
x AS (SELECT w.*, CASE WHEN s THEN cls END AS cls FROM w LEFT JOIN ts ON ts.page_id = w.page_id AND ts.k = w.k)
SELECT page_id, dense_rank() OVER (PARTITION BY page_id ORDER BY g) - 1 AS section, CAST(row_number() OVER (PARTITION BY page_id ORDER BY p, e) AS INTEGER) AS pos,
  widgetType, tag, text, src, alt, align, size, link, content,
  CASE WHEN shade >= 800 THEN '#1f2937' WHEN shade >= 600 THEN '#4b5563' WHEN shade >= 100 THEN '#f3f4f6' END AS section_background,
  TRY_CAST(regexp_extract(cls, '(?i)py-(\\d+)', 1) AS BIGINT) * 4 AS section_padding
FROM (SELECT *, TRY_CAST(regexp_extract(cls, '(?i)bg-(?:gray|slate|zinc|neutral|stone)-(\\d+)', 1) AS INTEGER) AS shade FROM x)
UNION ALL SELECT page_id, 0, 1, 'text-editor', NULL, NULL, NULL, NULL, NULL, NULL, NULL, html, NULL, NULL FROM src WHERE page_id NOT IN (SELECT page_id FROM w)"""


@query("html_to_widgets", oracle=WIDGETS_SQL)
def html_to_widgets(t):
    """Widget rows (section, position, type, texts, markup, settings) converted from each page's html."""
    return W.html_to_widgets(widget_pages(t))


def _special_sql() -> str:
    icon = _attr("data-icon")
    number = lambda x: f"coalesce(TRY_CAST(regexp_extract({x}, '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0)"
    given = lambda n, default: f"CASE WHEN {_attr(n)} IN ('', '0') THEN '{default}' ELSE {_attr(n)} END"
    listed = "('check', 'check-circle', 'star', 'arrow-right', 'chevron-right')"
    return f"""WITH RECURSIVE {nodes_sql()},
s AS (SELECT * FROM nd WHERE t IN ({TYPES})),
c AS (SELECT s.page_id, s.p AS own, s.attrs AS own_attrs, s.t AS own_t, nd.p, nd.name, nd.attrs, nd.txt FROM s JOIN nd ON nd.page_id = s.page_id AND nd.u = s.p WHERE {ELEMENT.replace('t ', 'nd.t ')}),
h AS (SELECT page_id, own, arg_min(txt, p) FILTER (name IN ('h3', 'h4', 'h5') AND txt NOT IN ('', '0')) AS box_title, arg_min(txt, p) FILTER (name IN ('h2', 'h3', 'h4') AND txt NOT IN ('', '0')) AS cta_title,
    {_trim("string_agg(txt || ' ', '' ORDER BY p) FILTER (name IN ('p', 'div', 'span'))")} AS box_text, {_trim("string_agg(txt || ' ', '' ORDER BY p) FILTER (name = 'p')")} AS cta_text,
    arg_max(txt, p) FILTER (name = 'a') AS a_text, arg_max({_attr('href')}, p) FILTER (name = 'a') AS a_href,
    to_json(list({{'title': NULL::VARCHAR, 'text': txt, 'icon': CASE WHEN {icon} IN {listed} THEN 'fa fa-' || {icon}
      WHEN (CASE WHEN {_attr('data-icon', 'own_attrs')} IN ('', '0') THEN 'check' ELSE {_attr('data-icon', 'own_attrs')} END) IN {listed}
      THEN 'fa fa-' || CASE WHEN {_attr('data-icon', 'own_attrs')} IN ('', '0') THEN 'check' ELSE {_attr('data-icon', 'own_attrs')} END ELSE 'fa fa-check' END}} ORDER BY p) FILTER (txt NOT IN ('', '0'))) AS entries
  FROM c GROUP BY page_id, own),
g AS (SELECT c.page_id, c.own, c.p, arg_max(nd.txt, nd.p) FILTER (CASE WHEN c.name = 'details' THEN nd.name = 'summary' ELSE nd.name IN ('h3', 'h4', 'h5', 'strong', 'b') END) AS q,
    coalesce({_trim("string_agg(nd.txt || ' ', '' ORDER BY nd.p) FILTER (CASE WHEN c.name = 'details' THEN nd.name <> 'summary' ELSE nd.name IN ('p', 'div', 'span') END)")}, '') AS a
  FROM c JOIN nd ON nd.page_id = c.page_id AND nd.u = c.p AND {ELEMENT.replace('t ', 'nd.t ')} WHERE c.name IN ('details', 'div') GROUP BY ALL),
i AS (SELECT page_id, own, to_json(list({{'title': q, 'text': a, 'icon': NULL::VARCHAR}} ORDER BY p)) AS pairs FROM g WHERE q NOT IN ('', '0') GROUP BY ALL)
SELECT s.page_id, CAST(row_number() OVER (PARTITION BY s.page_id ORDER BY s.p) AS INTEGER) AS pos, t AS widgetType,
  CASE t WHEN 'icon-box' THEN coalesce(box_title, txt) WHEN 'call-to-action' THEN coalesce(cta_title, '') WHEN 'counter' THEN txt END AS title,
  CASE t WHEN 'icon-box' THEN coalesce(box_text, '') WHEN 'call-to-action' THEN coalesce(cta_text, '') END AS text, txt AS content,
  CASE WHEN t = 'icon-box' THEN CASE WHEN {icon} IN ('', '0') THEN 'fa fa-star' WHEN {icon} IN ('wrench', 'check', 'star', 'phone', 'clock', 'shield', 'home', 'users', 'cog', 'bolt', 'heart', 'thumbs-up', 'award', 'certificate')
    THEN 'fa fa-' || {icon} ELSE {icon} END END AS icon,
  CASE WHEN t = 'counter' THEN {number(_attr('data-number'))} END AS number, CASE WHEN t = 'counter' THEN {given('data-prefix', '')} END AS prefix, CASE WHEN t = 'counter' THEN {given('data-suffix', '')} END AS suffix,
  CASE WHEN t = 'testimonial' THEN {given('data-name', 'Customer')} END AS name, CASE WHEN t = 'testimonial' THEN {given('data-company', '')} END AS company,
  CASE WHEN t = 'testimonial' THEN nullif({given('data-image', '')}, '') END AS image,
  TRY_CAST(regexp_extract(CASE t WHEN 'testimonial' THEN {_attr('data-rating')} WHEN 'star-rating' THEN {given('data-rating', '5')} END, '^\\s*([+-]?\\d+(?:\\.\\d+)?)', 1) AS DOUBLE) AS rating,
  CASE WHEN t = 'star-rating' THEN {number(given('data-scale', '5'))} END AS scale,
  CASE t WHEN 'button' THEN txt WHEN 'call-to-action' THEN coalesce(a_text, 'Learn More') END AS button,
  CASE t WHEN 'button' THEN {_attr('href')} WHEN 'call-to-action' THEN CASE WHEN a_href IS NULL OR a_href IN ('', '0') THEN '#' ELSE a_href END END AS link,
  CASE t WHEN 'icon-list' THEN coalesce(entries, '[]') WHEN 'accordion' THEN coalesce(pairs, to_json([{{'title': 'Frequently Asked Questions', 'text': txt, 'icon': NULL::VARCHAR}}])) END AS items
FROM s LEFT JOIN h ON h.page_id = s.page_id AND h.own = s.p LEFT JOIN i ON i.page_id = s.page_id AND i.own = s.p"""


@query("special_widgets", oracle=_special_sql())
def special_widgets(t):
    """data-elementor widgets (icon-box, accordion, testimonial, ...) with the settings and items of their type; items as JSON."""
    out = W.special_widgets(widget_pages(t))
    return out.withColumn("items", F.to_json("items", {"ignoreNullFields": "false"}))
