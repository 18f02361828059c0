"""M6 queries: brand tokens (colours, fonts, spacing, kit globals, slots).

Setting keys are ordered by name in both engines (VARIANT sorts object keys;
the reference walks them in document order, documented difference Q19).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.functions import color as C
from pagelens.operators import brand as BR
from pagelens.operators import tree as TR
from pagelens.plans.registry import query
from pagelens.sources.fixtures import with_views

BP_SQL = """bp AS (SELECT site_id, page_id, page_rank FROM (
  SELECT p.site_id, p.id AS page_id, row_number() OVER (PARTITION BY p.site_id ORDER BY p.menu_order, p.id) AS page_rank
  FROM posts p WHERE p.post_type IN ('page', 'post') AND p.post_status = 'publish'
    AND p.id IN (SELECT page_id FROM builder_trees)) WHERE page_rank <= 10)"""
ALL_SQL = BP_SQL.replace(" WHERE page_rank <= 10", "")

ST_SQL = f"""{ALL_SQL},
nodes AS (
  SELECT bp.site_id, bp.page_rank, jt.value AS node,
    list_transform(regexp_extract_all(jt.fullkey, '\\[(\\d+)\\]', 1), lambda x: CAST(x AS INTEGER)) AS path
  FROM builder_trees b JOIN bp ON bp.page_id = b.page_id, json_tree(b.tree_json) jt
  WHERE jt.type = 'OBJECT' AND regexp_matches(jt.fullkey, '^\\$\\[\\d+\\](\\.elements\\[\\d+\\])*$')),
st AS (SELECT n.site_id, n.page_rank, n.path, json_extract_string(n.node, '$.elType') AS elType,
         je.key, je.value, je.type AS vt,
         CASE WHEN je.type = 'VARCHAR' THEN json_extract_string(je.value, '$') END AS s
       FROM nodes n, json_each(json_extract(n.node, '$.settings')) je)"""


def _norm_sql(s: str) -> str:
    h3 = f"regexp_extract({s}, '^#([A-Fa-f0-9]{{3}})$', 1)"
    g = [f"TRY_CAST(regexp_extract({s}, 'rgba?\\s*\\(\\s*(\\d+)\\s*,\\s*(\\d+)\\s*,\\s*(\\d+)', {i}) AS BIGINT)"
         for i in (1, 2, 3)]
    return (f"CASE WHEN regexp_matches({s}, '^#([A-Fa-f0-9]{{6}})$') THEN upper({s}) "
            f"WHEN regexp_matches({s}, '^#([A-Fa-f0-9]{{3}})$') THEN '#' || upper(repeat(substr({h3}, 1, 1), 2) || "
            f"repeat(substr({h3}, 2, 1), 2) || repeat(substr({h3}, 3, 1), 2)) "
            f"WHEN regexp_matches({s}, 'rgba?\\s*\\(\\s*(\\d+)\\s*,\\s*(\\d+)\\s*,\\s*(\\d+)') "
            f"THEN printf('#%02X%02X%02X', {g[0]}, {g[1]}, {g[2]}) END")


COLOR_PROP = "(contains(key, 'color') OR contains(key, 'background') OR contains(key, '__globals__'))"
VALID = "(regexp_matches(s, '^#([A-Fa-f0-9]{6}|[A-Fa-f0-9]{3})$') OR regexp_matches(s, '^rgba?\\s*\\('))"

CF_SQL = f"""{ST_SQL},
cr AS (SELECT site_id, page_rank, path, key, {_norm_sql('s')} AS color FROM st
       WHERE {COLOR_PROP} AND vt = 'VARCHAR' AND {VALID}),
cr2 AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY page_rank, path, key) AS ord FROM cr
        WHERE color IS NOT NULL),
cf AS (SELECT site_id, color, CAST(count(*) AS BIGINT) AS count, min(ord) AS first_ord,
         string_agg(key, ',' ORDER BY ord) FILTER (WHERE fresh) AS contexts
       FROM (SELECT *, row_number() OVER (PARTITION BY site_id, color, key ORDER BY ord) = 1 AS fresh FROM cr2)
       GROUP BY site_id, color)"""


def _settings(t):
    return BR.analyzed_settings(t.posts, t.builder_trees)


@query("builder_pages_limit", oracle=f"WITH {BP_SQL} SELECT site_id, page_id, CAST(page_rank AS INTEGER) AS page_rank FROM bp",
       views=("posts", "builder_trees"))
def builder_pages_limit(t):
    """First 10 published builder pages per site by menu order."""
    return (BR.builder_pages_limit(t.posts, t.builder_trees)
            .select("site_id", "page_id", F.col("page_rank").cast("int").alias("page_rank")))


@query("meta_exists_filter", oracle="""
SELECT CAST(id AS BIGINT) AS id FROM posts WHERE id IN (SELECT page_id FROM builder_trees)
""", views=("posts", "builder_trees"))
def meta_exists_filter(t):
    """Posts that carry builder data (semi-join, no duplicates)."""
    return (t.posts.join(t.builder_trees.select(F.col("page_id").alias("id")), "id", "left_semi")
            .select(F.col("id").cast("bigint").alias("id")))


@query("color_frequency", oracle=f"WITH {CF_SQL} SELECT site_id, color, count, contexts FROM cf",
       views=("posts", "builder_trees"))
def color_frequency(t):
    """Per site: colour counts and contexts over the analysed builder pages."""
    cf = BR.color_frequency(_settings(t))
    return cf.select("site_id", "color", "count", F.array_join("contexts", ",").alias("contexts"))


@query("top_colors", oracle=f"""WITH {CF_SQL}
SELECT site_id, CAST(rank AS INTEGER) AS rank, color, count FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM cf) WHERE rank <= 20
""", views=("posts", "builder_trees"))
def top_colors(t):
    """Top 20 colours per site by count (ties: first seen)."""
    cf = BR.color_frequency(_settings(t))
    return BR.top_k(cf, BR.TOP_COLORS).select("site_id", F.col("rank").cast("int").alias("rank"), "color", "count")


TYPO_PROP = "(contains(key, 'typography') OR contains(key, 'font_family') OR contains(key, '__globals__'))"
FF_SQL = f"""{ST_SQL},
fr AS (SELECT site_id, page_rank, path, key,
         CASE WHEN vt = 'OBJECT' AND json_extract(value, '$.font_family') IS NOT NULL
              THEN CASE WHEN json_type(json_extract(value, '$.font_family')) = 'VARCHAR'
                        THEN json_extract_string(value, '$.font_family') END
              WHEN vt = 'VARCHAR' THEN s END AS family,
         coalesce(TRY_CAST(regexp_extract(CASE WHEN vt = 'OBJECT' THEN json_extract_string(value, '$.font_weight') END,
                                          '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0) AS weight
       FROM st WHERE {TYPO_PROP}
         AND ((vt = 'OBJECT' AND json_extract(value, '$.font_family') IS NOT NULL) OR (vt = 'VARCHAR' AND s NOT IN ('', '0')))),
fr2 AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY page_rank, path, key) AS ord FROM fr
        WHERE family IS NOT NULL AND family NOT IN ('', '0') AND family <> 'inherit'),
fw AS (SELECT site_id, family, weight, min(ord) AS o FROM fr2 WHERE weight <> 0 GROUP BY site_id, family, weight),
ff AS (SELECT f.site_id, f.family, CAST(count(*) AS BIGINT) AS count, min(ord) AS first_ord,
         coalesce((SELECT string_agg(CAST(weight AS VARCHAR), ',' ORDER BY o) FROM fw
                   WHERE fw.site_id = f.site_id AND fw.family = f.family), '') AS weights
       FROM fr2 f GROUP BY f.site_id, f.family)"""


@query("font_frequency", oracle=f"WITH {FF_SQL} SELECT site_id, family, count, weights FROM ff",
       views=("posts", "builder_trees"))
def font_frequency(t):
    """Per site: font family counts and distinct weights over the analysed pages."""
    ff = BR.font_frequency(_settings(t))
    return ff.select("site_id", "family", "count",
                     F.array_join(F.col("weights").cast("array<string>"), ",").alias("weights"))


@query("top_fonts", oracle=f"""WITH {FF_SQL}
SELECT site_id, CAST(rank AS INTEGER) AS rank, family, count FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM ff) WHERE rank <= 10
""", views=("posts", "builder_trees"))
def top_fonts(t):
    """Top 10 font families per site by count."""
    ff = BR.font_frequency(_settings(t))
    return BR.top_k(ff, BR.TOP_FONTS).select("site_id", F.col("rank").cast("int").alias("rank"), "family", "count")


@query("spacing_tokens", oracle=f"""WITH {ST_SQL},
sp AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY page_rank, path, key) AS ord FROM st
       WHERE elType IN ('section', 'container'))
SELECT s.site_id,
  (SELECT CAST(json(value) AS VARCHAR) FROM sp WHERE sp.site_id = s.site_id AND key = 'padding'
     AND vt IN ('OBJECT', 'ARRAY') ORDER BY ord DESC LIMIT 1) AS section_padding,
  (SELECT json_extract_string(value, '$.size') || coalesce(json_extract_string(value, '$.unit'), 'px') FROM sp
     WHERE sp.site_id = s.site_id AND key = 'content_width' AND vt IN ('OBJECT', 'ARRAY')
       AND json_extract_string(value, '$.size') IS NOT NULL ORDER BY ord DESC LIMIT 1) AS container_width
FROM (SELECT DISTINCT site_id FROM sp) s""", views=("posts", "builder_trees"))
def spacing_tokens(t):
    """Last section padding and container width seen per site."""
    return BR.spacing_tokens(_settings(t))


KIT_SQL = """kl AS (
  SELECT k.site_id, g.section, g.grp, CAST(je.key AS INTEGER) AS i, g.prefix || json_extract_string(je.value, '$._id') AS key,
    coalesce(json_extract_string(je.value, '$.title'), g.dflt,
             upper(substr(json_extract_string(je.value, '$._id'), 1, 1)) || substr(json_extract_string(je.value, '$._id'), 2)) AS name,
    CASE WHEN g.section = 'color' THEN json_extract_string(je.value, '$.color')
         ELSE json_extract_string(je.value, '$.typography_font_family') END AS value,
    CASE WHEN g.section = 'typography' THEN json_extract_string(je.value, '$.typography_font_weight') END AS weight
  FROM kit_settings k,
    (VALUES ('system_colors', 'color', 0, '', NULL), ('custom_colors', 'color', 1, 'custom_', 'Custom'),
            ('system_typography', 'typography', 0, '', NULL), ('custom_typography', 'typography', 1, 'custom_', 'Custom'))
      g(list, section, grp, prefix, dflt),
    json_each(json_extract(k.settings_json, '$.' || g.list)) je
  WHERE coalesce(json_extract_string(je.value, '$._id'), '') NOT IN ('', '0')
    AND (g.section = 'typography' OR coalesce(json_extract_string(je.value, '$.color'), '') NOT IN ('', '0'))),
km AS (SELECT site_id, section, key, min(grp * 1000000 + i) AS first, arg_max(name, grp * 1000000 + i) AS name,
         arg_max(value, grp * 1000000 + i) AS value, arg_max(weight, grp * 1000000 + i) AS weight
       FROM kl GROUP BY site_id, section, key),
kt AS (
  SELECT site_id, section, CAST(row_number() OVER (PARTITION BY site_id, section ORDER BY first) AS INTEGER) AS pos,
    key, name, value, weight FROM km
  UNION ALL
  SELECT site_id, 'button', 0, b.key, NULL, json_extract_string(settings_json, '$.' || b.path),
    CASE WHEN b.key = 'typography' THEN json_extract_string(settings_json, '$.button_typography_font_weight') END
  FROM kit_settings, (VALUES ('typography', 'button_typography_font_family', 'button_typography_typography'),
      ('text_color', 'button_text_color', 'button_text_color'),
      ('background_color', 'button_background_color', 'button_background_color'),
      ('border_radius', 'button_border_radius', 'button_border_radius')) b(key, path, gate)
  WHERE coalesce(json_extract_string(settings_json, '$.' || b.gate), '') NOT IN ('', '0'))"""


@query("kit_tokens", oracle=f"WITH {KIT_SQL} SELECT * FROM kt", views=("kit_settings",))
def kit_tokens(t):
    """Site kit globals: system/custom colours and typography, button settings."""
    return BR.kit_tokens(t.kit_settings).select("site_id", "section", F.col("pos").cast("int").alias("pos"),
                                                "key", "name", "value", "weight")


FM_SQL = f"""{FF_SQL}, {KIT_SQL},
tf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM ff)
       WHERE rank <= 10),
g AS (SELECT site_id, CAST(pos AS BIGINT) AS pos, value AS family, 'global' AS source, name,
        CASE WHEN coalesce(TRY_CAST(regexp_extract(weight, '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0) <> 0
             THEN CAST(TRY_CAST(regexp_extract(weight, '^\\s*([+-]?\\d+)', 1) AS BIGINT) AS VARCHAR) ELSE '400' END AS weights,
        CAST(NULL AS BIGINT) AS frequency
      FROM kt WHERE section = 'typography'),
e0 AS (SELECT site_id, rank, trim(family, chr(32) || chr(9) || chr(10) || chr(13) || chr(11)) AS family, weights, count FROM tf),
e1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id, lower(family) ORDER BY rank) AS r FROM e0
       WHERE family <> '' AND lower(family) <> 'inherit') WHERE r = 1
       AND NOT EXISTS (SELECT 1 FROM g WHERE g.site_id = e1_site AND lower(coalesce(g.family, '')) = lower(family))),
fm AS (SELECT * FROM g UNION ALL
  SELECT e.site_id, CAST(coalesce((SELECT count(*) FROM g WHERE g.site_id = e.site_id), 0)
           + row_number() OVER (PARTITION BY e.site_id ORDER BY e.rank) AS BIGINT) AS pos,
    e.family, 'extracted', 'Font: ' || e.family, e.weights, e.count FROM e1 e)"""

# e1 needs the outer site id inside NOT EXISTS; spelled out explicitly:
FM_SQL = FM_SQL.replace("e1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id, lower(family) ORDER BY rank) AS r FROM e0\n"
                        "       WHERE family <> '' AND lower(family) <> 'inherit') WHERE r = 1\n"
                        "       AND NOT EXISTS (SELECT 1 FROM g WHERE g.site_id = e1_site AND lower(coalesce(g.family, '')) = lower(family))),",
                        "e1 AS (SELECT x.* FROM (SELECT *, row_number() OVER (PARTITION BY site_id, lower(family) ORDER BY rank) AS r FROM e0\n"
                        "       WHERE family <> '' AND lower(family) <> 'inherit') x WHERE x.r = 1\n"
                        "       AND NOT EXISTS (SELECT 1 FROM g WHERE g.site_id = x.site_id AND lower(coalesce(g.family, '')) = lower(x.family))),")


def _font_merge(t):
    ff = BR.font_frequency(_settings(t))
    return BR.font_merge(BR.kit_tokens(t.kit_settings), BR.top_k(ff, BR.TOP_FONTS))


@query("font_merge", oracle=f"WITH {FM_SQL} SELECT * FROM fm", views=("posts", "builder_trees", "kit_settings"))
def font_merge(t):
    """Global fonts followed by extracted top fonts not already present (case-insensitive)."""
    fm = _font_merge(t)
    return fm.select("site_id", "pos", "family", "source", "name",
                     F.array_join(F.col("weights").cast("array<string>"), ",").alias("weights"), "frequency")


@query("font_slots", oracle=f"""WITH {FM_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY coalesce(frequency, 0) DESC, pos) - 1 AS i FROM fm)
SELECT site_id, s.slot, CAST(CASE WHEN i >= 2 THEN i - 2 ELSE 0 END AS INTEGER) AS ord, family, source, name, frequency
FROM r, (VALUES (0, 'primary'), (0, 'body'), (1, 'secondary'), (1, 'heading'), (2, 'additional')) s(k, slot)
WHERE (i < 2 AND s.k = i) OR (i >= 2 AND i < 5 AND s.k = 2)""", views=("posts", "builder_trees", "kit_settings"))
def font_slots(t):
    """Typography slots per site: rank 0 primary/body, rank 1 secondary/heading, up to 3 more."""
    return BR.font_slots(_font_merge(t))


def _color_merge(t):
    cf = BR.color_frequency(_settings(t))
    return BR.color_merge(BR.kit_tokens(t.kit_settings), BR.top_k(cf, BR.TOP_COLORS))


def _chan_sql(v: str, i: int) -> str:
    return (f"coalesce(TRY_CAST(('0x' || nullif(regexp_replace(substr(ltrim({v}, '#'), {i}, 2), '[^0-9A-Fa-f]', '', 'g'), ''))"
            f" AS INTEGER), 0)")


def _similar_sql(a: str, b: str) -> str:
    ok = f"length(ltrim({a}, '#')) = 6 AND length(ltrim({b}, '#')) = 6"
    d = " + ".join(f"pow({_chan_sql(a, i)} - {_chan_sql(b, i)}, 2)" for i in (1, 3, 5))
    return f"({ok} AND sqrt({d}) < 30)"


@query("color_merge", oracle=f"""WITH RECURSIVE {CF_SQL}, {KIT_SQL},
tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM cf)
       WHERE rank <= 20),
ex AS (SELECT site_id, color, count, row_number() OVER (PARTITION BY site_id ORDER BY rank) AS rn FROM tc
       WHERE regexp_matches(color, '^#[A-Fa-f0-9]{{6}}$')),
g AS (SELECT site_id, list({{'kid': key, 'value': value, 'source': 'global', 'frequency': 999}} ORDER BY pos) AS acc
      FROM kt WHERE section = 'color' GROUP BY site_id),
sites AS (SELECT site_id FROM g UNION SELECT site_id FROM ex),
f(site_id, rn, acc) AS (
  SELECT s.site_id, 0, coalesce(g.acc, []) FROM sites s LEFT JOIN g ON g.site_id = s.site_id
  UNION ALL
  SELECT f.site_id, f.rn + 1,
    CASE WHEN len(list_filter(f.acc, lambda a: {_similar_sql('a.value', 'ex.color')})) > 0 THEN f.acc
         ELSE list_append(f.acc, {{'kid': ex.color, 'value': ex.color, 'source': 'extracted', 'frequency': ex.count}}) END
  FROM f JOIN ex ON ex.site_id = f.site_id AND ex.rn = f.rn + 1),
fin AS (SELECT site_id, arg_max(acc, rn) AS acc FROM f GROUP BY site_id)
SELECT site_id, CAST(generate_subscripts(acc, 1) - 1 AS INTEGER) AS pos, unnest(acc).kid AS kid, unnest(acc).value AS value,
  unnest(acc).source AS source, CAST(unnest(acc).frequency AS BIGINT) AS frequency FROM fin""",
       views=("posts", "builder_trees", "kit_settings"))
def color_merge(t):
    """Globals + extracted colours not similar (RGB distance < 30) to any kept colour (ordered fold)."""
    cm = _color_merge(t)
    return cm.select("site_id", F.posexplode("colors").alias("pos", "c")).select(
        "site_id", "pos", "c.kid", "c.value", "c.source", "c.frequency")


SLOT_NAMES = "['primary', 'secondary', 'accent', 'text', 'heading', 'background', 'buttonBg', 'buttonText']"


def _name_sql(c: str, ctx: str) -> str:
    r, g, b = (_chan_sql(c, i) for i in (1, 3, 5))
    lum = f"((0.299 * {r} + 0.587 * {g} + 0.114 * {b}) / 255)"
    return f"""CASE WHEN length(ltrim({c}, '#')) <> 6 THEN 'Color'
  WHEN contains({ctx}, 'button') THEN 'Button Color'
  WHEN contains({ctx}, 'heading') OR contains({ctx}, 'title') THEN 'Heading Color'
  WHEN contains({ctx}, 'background') THEN 'Background' WHEN contains({ctx}, 'link') THEN 'Link Color'
  WHEN {lum} > 0.95 THEN 'White/Light' WHEN {lum} < 0.05 THEN 'Black/Dark' WHEN {lum} > 0.8 THEN 'Light Background'
  WHEN {lum} < 0.2 THEN 'Dark Text' WHEN greatest({r}, {g}, {b}) - least({r}, {g}, {b}) < 20 THEN 'Neutral Gray'
  WHEN {r} >= {g} AND {r} >= {b} THEN CASE WHEN {g} > {b} THEN 'Orange/Yellow' ELSE 'Red/Pink' END
  WHEN {g} >= {r} AND {g} >= {b} THEN CASE WHEN {b} > {r} THEN 'Teal/Cyan' ELSE 'Green' END
  WHEN {b} >= {r} AND {b} >= {g} THEN CASE WHEN {r} > {g} THEN 'Purple/Violet' ELSE 'Blue' END
  ELSE 'Accent Color' END"""


def _lum_sql(c: str) -> str:
    r, g, b = (_chan_sql(c, i) for i in (1, 3, 5))
    return f"((0.299 * {r} + 0.587 * {g} + 0.114 * {b}) / 255)"


CT = "STRUCT(value VARCHAR, name VARCHAR, source VARCHAR, frequency BIGINT)"
TG_SQL = """CASE WHEN NOT o.ok THEN 'skip'
     WHEN o.c.source = 'global' THEN CASE
        WHEN contains(o.nm, 'primary') AND ss.sl[1] IS NULL THEN 'primary'
        WHEN contains(o.nm, 'secondary') AND ss.sl[2] IS NULL THEN 'secondary'
        WHEN contains(o.nm, 'accent') AND ss.sl[3] IS NULL THEN 'accent'
        WHEN contains(o.nm, 'text') AND ss.sl[4] IS NULL THEN 'text' ELSE 'additional' END
     WHEN contains(o.nm, 'button') THEN CASE WHEN ss.sl[7] IS NULL THEN 'buttonBg' WHEN ss.sl[8] IS NULL THEN 'buttonText'
        ELSE 'skip' END
     WHEN contains(o.nm, 'heading') AND ss.sl[5] IS NULL THEN 'heading'
     WHEN contains(o.nm, 'background') AND o.lum > 0.7 AND ss.sl[6] IS NULL THEN 'background'
     WHEN o.lum < 0.3 AND ss.sl[4] IS NULL THEN 'text'
     WHEN ss.sl[1] IS NULL AND o.lum > 0.2 AND o.lum < 0.8 THEN 'primary'
     WHEN ss.sl[2] IS NULL AND o.lum > 0.2 AND o.lum < 0.8 THEN 'secondary'
     ELSE 'additional' END"""


@query("color_slots", oracle=f"""WITH RECURSIVE {CF_SQL}, {KIT_SQL},
tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM cf)
       WHERE rank <= 20),
ex AS (SELECT site_id, color, count, {_name_sql('color', 'contexts')} AS name,
         row_number() OVER (PARTITION BY site_id ORDER BY rank) AS rn FROM tc
       WHERE regexp_matches(color, '^#[A-Fa-f0-9]{{6}}$')),
g AS (SELECT site_id, list(CAST({{'value': value, 'name': name, 'source': 'global', 'frequency': 999}} AS {CT}) ORDER BY pos) AS acc
      FROM kt WHERE section = 'color' GROUP BY site_id),
sites AS (SELECT site_id FROM g UNION SELECT site_id FROM ex),
f(site_id, rn, acc) AS (
  SELECT s.site_id, 0, coalesce(g.acc, CAST([] AS {CT}[])) FROM sites s LEFT JOIN g ON g.site_id = s.site_id
  UNION ALL
  SELECT f.site_id, f.rn + 1,
    CASE WHEN len(list_filter(f.acc, lambda a: {_similar_sql('a.value', 'ex.color')})) > 0 THEN f.acc
         ELSE list_append(f.acc, CAST({{'value': ex.color, 'name': ex.name, 'source': 'extracted', 'frequency': ex.count}} AS {CT})) END
  FROM f JOIN ex ON ex.site_id = f.site_id AND ex.rn = f.rn + 1),
fin AS (SELECT site_id, arg_max(acc, rn) AS acc FROM f GROUP BY site_id),
mu AS (SELECT site_id, generate_subscripts(acc, 1) AS pos, unnest(acc) AS c FROM fin),
o AS (SELECT site_id, row_number() OVER (PARTITION BY site_id ORDER BY c.frequency DESC, pos) AS k, c,
        lower(coalesce(c.name, '')) AS nm, length(ltrim(c.value, '#')) = 6 AS ok, {_lum_sql('c.value')} AS lum FROM mu),
ss(site_id, k, sl, ad) AS (
  SELECT site_id, 0, list_transform(range(8), lambda i: CAST(NULL AS {CT})), CAST([] AS {CT}[]) FROM fin
  UNION ALL
  SELECT ss.site_id, ss.k + 1,
    list_transform(range(8), lambda i: CASE WHEN {SLOT_NAMES}[i + 1] = ({TG_SQL}) THEN o.c ELSE ss.sl[i + 1] END),
    CASE WHEN ({TG_SQL}) = 'additional' THEN list_append(ss.ad, o.c) ELSE ss.ad END
  FROM ss JOIN o ON o.site_id = ss.site_id AND o.k = ss.k + 1),
fs AS (SELECT site_id, arg_max(sl, k) AS sl, arg_max(ad, k) AS ad FROM ss GROUP BY site_id),
named AS (SELECT site_id, {SLOT_NAMES}[generate_subscripts(sl, 1)] AS slot, 0 AS ord, unnest(sl) AS c FROM fs),
extra AS (SELECT site_id, 'additional' AS slot, generate_subscripts(ad, 1) - 1 AS ord, unnest(ad) AS c FROM fs)
SELECT site_id, slot, CAST(ord AS INTEGER) AS ord, c.value AS value, c.name AS name, c.source AS source,
  CAST(c.frequency AS BIGINT) AS frequency
FROM (SELECT * FROM named UNION ALL SELECT * FROM extra WHERE ord < 5) WHERE c IS NOT NULL""",
       views=("posts", "builder_trees", "kit_settings"))
def color_slots(t):
    """Colour slots per site (primary ... buttonText, up to 5 additional) by greedy fold."""
    return BR.color_slots(_color_merge(t))


def _brand_sql() -> str:
    from pagelens.plans.registry import REGISTRY

    def sub(k):
        return f"({REGISTRY[k].oracle}) q_{k}"
    return f"""
SELECT site_id, 'colors' AS section, slot, CAST(ord AS INTEGER) AS ord, value, name, source, CAST(frequency AS BIGINT) AS frequency
FROM {sub('color_slots')}
UNION ALL SELECT site_id, 'typography', slot, CAST(ord AS INTEGER), family, name, source, CAST(frequency AS BIGINT) FROM {sub('font_slots')}
UNION ALL SELECT site_id, 'spacing', 'section_padding', 0, section_padding, NULL, NULL, NULL FROM {sub('spacing_tokens')}
  WHERE section_padding IS NOT NULL
UNION ALL SELECT site_id, 'spacing', 'container_width', 0, container_width, NULL, NULL, NULL FROM {sub('spacing_tokens')}
  WHERE container_width IS NOT NULL
UNION ALL SELECT site_id, 'meta', m.slot, 0, CASE m.slot WHEN 'pagesAnalyzed' THEN CAST(n AS VARCHAR)
    WHEN 'version' THEN '1' ELSE 'draft' END, NULL, NULL, NULL
  FROM (SELECT site_id, count(*) AS n FROM ({with_views(f"WITH {ALL_SQL} SELECT * FROM bp", "posts", "builder_trees")}) GROUP BY site_id) p,
       (VALUES ('pagesAnalyzed'), ('version'), ('status')) m(slot)"""


@query("brand_tokens", oracle=_brand_sql())
def brand_tokens(t):
    """Brand token record per site as rows: colour and font slots, spacing, pages analysed, version, status."""
    st = _settings(t)
    kit = BR.kit_tokens(t.kit_settings)
    cm = BR.color_merge(kit, BR.top_k(BR.color_frequency(st), BR.TOP_COLORS))
    fm = BR.font_merge(kit, BR.top_k(BR.font_frequency(st), BR.TOP_FONTS))
    pages = BR.builder_pages(t.posts).join(t.builder_trees.select("page_id"), "page_id", "left_semi")
    return BR.brand_token_rows(BR.color_slots(cm), BR.font_slots(fm), BR.spacing_tokens(st), pages)


@query("color_similarity", oracle=f"""WITH {CF_SQL}, {KIT_SQL},
tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY count DESC, first_ord) AS rank FROM cf)
       WHERE rank <= 20),
g AS (SELECT site_id, value FROM kt WHERE section = 'color')
SELECT tc.site_id, tc.color, coalesce((SELECT bool_or(
    length(ltrim(g.value, '#')) = 6 AND length(ltrim(tc.color, '#')) = 6 AND sqrt(
    pow(CAST(('0x' || substr(ltrim(g.value, '#'), 1, 2)) AS INTEGER) - CAST(('0x' || substr(ltrim(tc.color, '#'), 1, 2)) AS INTEGER), 2) +
    pow(CAST(('0x' || substr(ltrim(g.value, '#'), 3, 2)) AS INTEGER) - CAST(('0x' || substr(ltrim(tc.color, '#'), 3, 2)) AS INTEGER), 2) +
    pow(CAST(('0x' || substr(ltrim(g.value, '#'), 5, 2)) AS INTEGER) - CAST(('0x' || substr(ltrim(tc.color, '#'), 5, 2)) AS INTEGER), 2)) < 30)
  FROM g WHERE g.site_id = tc.site_id), false) AS similar_to_global
FROM tc""", views=("posts", "builder_trees", "kit_settings"))
def color_similarity(t):
    """Whether each top colour is within RGB distance 30 of one of its site's global colours.

    The per-site globals are a bounded array (kit size), joined on site_id and
    tested with ``exists``: no pair join.
    """
    cf = BR.color_frequency(_settings(t))
    tc = BR.top_k(cf, BR.TOP_COLORS)
    g = (BR.kit_tokens(t.kit_settings).filter(F.col("section") == "color")
         .withColumn("_rgb", C.hex_to_rgb(F.col("value")))
         .groupBy("site_id").agg(F.collect_list("_rgb").alias("globals")))
    tc = tc.withColumn("_rgb", C.hex_to_rgb(F.col("color")))
    sim = F.exists(F.coalesce("globals", F.array().cast("array<struct<r:int,g:int,b:int>>")),
                   lambda gv: C.color_distance_lt(gv, F.col("_rgb")))
    return tc.join(g, "site_id", "left").select("site_id", "color", sim.alias("similar_to_global"))


VALS_SQL = """SELECT b.page_id, array_to_string(list_transform(regexp_extract_all(jt.fullkey, '\\[(\\d+)\\]', 1),
    lambda x: CAST(x AS INTEGER)), '.') AS path, je.key, json_extract_string(je.value, '$') AS value
  FROM builder_trees b, json_tree(b.tree_json) jt, json_each(json_extract(jt.value, '$.settings')) je
  WHERE jt.type = 'OBJECT' AND regexp_matches(jt.fullkey, '^\\$\\[\\d+\\](\\.elements\\[\\d+\\])*$') AND je.type = 'VARCHAR'"""


def _values(t):
    """(page_id, path, key, value) for every string setting of every builder node."""
    n = TR.tree_nodes(t.builder_trees)
    kv = n.select("page_id", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"),
                  F.explode(F.try_variant_get("settings", "$", "map<string,variant>")).alias("key", "v"))
    return kv.select("page_id", "path", "key", TR.vstring(F.col("v")).alias("value")).filter(F.col("value").isNotNull())


@query("is_color_property", oracle=f"""SELECT page_id, path, key,
  (contains(key, 'color') OR contains(key, 'background') OR contains(key, '__globals__')) AS is_color,
  (contains(key, 'typography') OR contains(key, 'font_family') OR contains(key, '__globals__')) AS is_typography
FROM ({VALS_SQL})""", views=("builder_trees",))
def is_color_property(t):
    """Colour/typography key tests on every string setting of every builder node."""
    return _values(t).select("page_id", "path", "key", C.is_color_property(F.col("key")).alias("is_color"),
                             C.is_typography_property(F.col("key")).alias("is_typography"))


@query("normalize_hex", oracle=f"""SELECT page_id, path, key, value,
  (regexp_matches(value, '^#([A-Fa-f0-9]{{6}}|[A-Fa-f0-9]{{3}})$') OR regexp_matches(value, '^rgba?\\s*\\(')) AS valid,
  {_norm_sql('value')} AS hex
FROM ({VALS_SQL}) WHERE contains(key, 'color')""", views=("builder_trees",))
def normalize_hex(t):
    """Validity and #RRGGBB form of every colour setting value."""
    v = _values(t).filter(F.contains(F.col("key"), F.lit("color")))
    return v.select("page_id", "path", "key", "value", C.is_valid_color(F.col("value")).alias("valid"),
                    C.normalize_hex(F.col("value")).alias("hex"))


RGB_SQL = """CASE WHEN length(ltrim(h, '#')) = 6 THEN CAST(('0x' || substr(ltrim(h, '#'), {i}, 2)) AS INTEGER) END"""


@query("hex_to_rgb", oracle=f"""WITH v AS (SELECT page_id, path, key, {_norm_sql('value')} AS h FROM ({VALS_SQL})
  WHERE contains(key, 'color')),
c AS (SELECT *, {RGB_SQL.format(i=1)} AS r, {RGB_SQL.format(i=3)} AS g, {RGB_SQL.format(i=5)} AS b FROM v
      WHERE h IS NOT NULL)
SELECT page_id, path, key, h, r, g, b, round((0.299 * r + 0.587 * g + 0.114 * b) / 255, 6) AS luminance FROM c
""", views=("builder_trees",))
def hex_to_rgb(t):
    """RGB channels and luminance of every normalized colour (NULL unless 6 digits)."""
    v = _values(t).filter(F.contains(F.col("key"), F.lit("color")))
    h = v.select("page_id", "path", "key", C.normalize_hex(F.col("value")).alias("h")).filter(F.col("h").isNotNull())
    rgb = C.hex_to_rgb(F.col("h"))
    return h.select("page_id", "path", "key", "h", rgb["r"].alias("r"), rgb["g"].alias("g"), rgb["b"].alias("b"),
                    F.round(C.luminance(rgb), 6).alias("luminance"))


RGBS = "CASE WHEN length(ltrim(color, '#')) = 6 THEN CAST(('0x' || substr(ltrim(color, '#'), {i}, 2)) AS INTEGER) END"


@query("color_name", oracle=f"""WITH {CF_SQL},
c AS (SELECT site_id, color, contexts, {RGBS.format(i=1)} AS r, {RGBS.format(i=3)} AS g, {RGBS.format(i=5)} AS b FROM cf),
l AS (SELECT *, (0.299 * r + 0.587 * g + 0.114 * b) / 255 AS lum, greatest(r, g, b) - least(r, g, b) AS spread FROM c)
SELECT site_id, color, CASE WHEN r IS NULL THEN 'Color'
  WHEN contains(contexts, 'button') THEN 'Button Color'
  WHEN contains(contexts, 'heading') OR contains(contexts, 'title') THEN 'Heading Color'
  WHEN contains(contexts, 'background') THEN 'Background' WHEN contains(contexts, 'link') THEN 'Link Color'
  WHEN lum > 0.95 THEN 'White/Light' WHEN lum < 0.05 THEN 'Black/Dark' WHEN lum > 0.8 THEN 'Light Background'
  WHEN lum < 0.2 THEN 'Dark Text' WHEN spread < 20 THEN 'Neutral Gray'
  WHEN r >= g AND r >= b THEN CASE WHEN g > b THEN 'Orange/Yellow' ELSE 'Red/Pink' END
  WHEN g >= r AND g >= b THEN CASE WHEN b > r THEN 'Teal/Cyan' ELSE 'Green' END
  WHEN b >= r AND b >= g THEN CASE WHEN r > g THEN 'Purple/Violet' ELSE 'Blue' END
  ELSE 'Accent Color' END AS name
FROM l""", views=("posts", "builder_trees"))
def color_name(t):
    """Suggested name of every top colour from its contexts, luminance and hue."""
    cf = BR.color_frequency(_settings(t))
    cf = cf.withColumn("_rgb", C.hex_to_rgb(F.col("color")))
    return cf.select("site_id", "color", C.color_name(F.col("color"), F.col("contexts"), F.col("_rgb")).alias("name"))


@query("font_weights", oracle=f"""WITH {KIT_SQL}
SELECT site_id, key, CASE WHEN coalesce(TRY_CAST(regexp_extract(weight, '^\\s*([+-]?\\d+)', 1) AS BIGINT), 0) <> 0
  THEN CAST(TRY_CAST(regexp_extract(weight, '^\\s*([+-]?\\d+)', 1) AS BIGINT) AS VARCHAR) ELSE '400' END AS weights
FROM kt WHERE section = 'typography'""", views=("kit_settings",))
def font_weights(t):
    """Integer weights (default [400]) of every kit typography entry."""
    k = BR.kit_tokens(t.kit_settings).filter(F.col("section") == "typography")
    return k.select("site_id", "key", F.array_join(C.font_weights(F.col("weight")).cast("array<string>"), ",")
                    .alias("weights"))
