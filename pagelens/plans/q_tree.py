"""M6 queries: builder tree nodes, text, images, blocks, compatibility, H1 action.

DuckDB oracle: ``json_tree`` lists every node with its full key, from which
the pre-order path is read. VARIANT stores object keys sorted, so object
values are ordered by key in the oracle too (documented difference Q19).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import seo as S
from pagelens.operators import tree as TR
from pagelens.plans.duck import falsy_sql, strip_sql
from pagelens.plans.registry import query

NODES_SQL = """nodes AS (
  SELECT b.page_id, b.site_id, b.menu_order, jt.value AS node,
    list_transform(regexp_extract_all(jt.fullkey, '\\[(\\d+)\\]', 1), lambda x: CAST(x AS INTEGER)) AS path
  FROM builder_trees b, json_tree(b.tree_json) jt
  WHERE jt.type = 'OBJECT' AND regexp_matches(jt.fullkey, '^\\$\\[\\d+\\](\\.elements\\[\\d+\\])*$')),
nd AS (SELECT page_id, site_id, menu_order, path, json_extract_string(node, '$.widgetType') AS widgetType,
  json_extract(node, '$.settings') AS settings FROM nodes)"""


@query("tree_nodes", oracle=f"""WITH {NODES_SQL}
SELECT page_id, array_to_string(path, '.') AS path, CAST(len(path) - 1 AS INTEGER) AS depth,
  json_extract_string(node, '$.id') AS id, json_extract_string(node, '$.elType') AS elType,
  json_extract_string(node, '$.widgetType') AS widgetType
FROM nodes""", views=("builder_trees",))
def tree_nodes(t):
    """Every node of every builder tree with its pre-order path and depth."""
    n = TR.tree_nodes(t.builder_trees)
    return n.select("page_id", F.array_join(F.col("path").cast("array<string>"), ".").alias("path"),
                    "depth", "id", "elType", "widgetType")


def _fields_sql(fields, alias="fv") -> str:
    vals = ", ".join(f"({i}, '{f}')" for i, f in enumerate(fields))
    return f"""{alias} AS (
  SELECT nd.page_id, nd.path, fl.f, json_extract(nd.settings, '$."' || fl.name || '"') AS v
  FROM nd, (VALUES {vals}) fl(f, name)
  WHERE json_extract(nd.settings, '$."' || fl.name || '"') IS NOT NULL)"""


def _items_sql(src: str, alias: str, val: str, keys: str) -> str:
    """Values of arrays/objects with their VARIANT-order index."""
    q = ", ".join(f"s0.{k.strip()}" for k in keys.split(","))
    sel = ", ".join(f"s0.{k.strip()} AS {k.strip()}" for k in keys.split(","))
    return f"""{alias} AS (
  SELECT {sel}, row_number() OVER (PARTITION BY {q} ORDER BY
      CASE WHEN json_type(s0.{val}) = 'ARRAY' THEN lpad(je.key, 12, '0') ELSE je.key END) - 1 AS idx,
    je.value AS item
  FROM {src} s0, json_each(s0.{val}) je WHERE json_type(s0.{val}) IN ('ARRAY', 'OBJECT'))"""


TEXT_SQL = f"""{NODES_SQL},
{_fields_sql(TR.TREE_TEXT_FIELDS)},
{_items_sql('fv', 'it', 'v', 'page_id, path, f')},
sb AS (SELECT it.page_id, it.path, it.f, it.idx AS i, s.idx AS j, s.item AS sv FROM it,
  LATERAL (SELECT row_number() OVER (ORDER BY CASE WHEN json_type(it.item) = 'ARRAY' THEN lpad(je.key, 12, '0')
                                      ELSE je.key END) - 1 AS idx, je.value AS item
           FROM json_each(it.item) je) s
  WHERE json_type(it.item) IN ('ARRAY', 'OBJECT')),
raw AS (
  SELECT page_id, path, f, -1 AS i, -1 AS j, CASE WHEN json_type(v) = 'VARCHAR' THEN json_extract_string(v, '$') END AS r FROM fv
  UNION ALL SELECT page_id, path, f, idx, -1, CASE WHEN json_type(item) = 'VARCHAR' THEN json_extract_string(item, '$') END FROM it
  UNION ALL SELECT page_id, path, f, i, j, CASE WHEN json_type(sv) = 'VARCHAR' THEN json_extract_string(sv, '$') END FROM sb),
pieces AS (SELECT page_id, path, f, i, j, {strip_sql('r')} AS text FROM raw WHERE NOT {falsy_sql('r')})"""


@query("tree_text", oracle=f"""WITH {TEXT_SQL}
SELECT page_id, string_agg(text, ' ' ORDER BY path, f, i, j) AS text FROM pieces
WHERE NOT {falsy_sql('text')} GROUP BY page_id""", views=("builder_trees",))
def tree_text(t):
    """Builder text of every page from 31 text settings, in pre-order."""
    return TR.tree_text(TR.tree_nodes(t.builder_trees))


IMG_FIELDS = TR.TREE_IMAGE_FIELDS + ("_background_image",)


@query("tree_images", oracle=f"""WITH {NODES_SQL},
{_fields_sql(IMG_FIELDS)},
single AS (SELECT page_id, path, f, -1 AS i, -1 AS j, v AS obj FROM fv
           WHERE json_type(v) IN ('OBJECT', 'ARRAY') AND json_extract(v, '$.url') IS NOT NULL),
{_items_sql(f"(SELECT * FROM fv WHERE f < {len(TR.TREE_IMAGE_FIELDS)} AND json_extract(v, '$.url') IS NULL)", 'it', 'v', 'page_id, path, f')},
it2 AS (SELECT * FROM it WHERE json_type(item) IN ('OBJECT', 'ARRAY')),
item_obj AS (SELECT page_id, path, f, idx AS i, -1 AS j, item AS obj FROM it2 WHERE json_extract(item, '$.url') IS NOT NULL),
sub_obj AS (SELECT it2.page_id, it2.path, it2.f, it2.idx AS i, s.idx AS j, s.item AS obj FROM it2,
  LATERAL (SELECT row_number() OVER (ORDER BY CASE WHEN json_type(it2.item) = 'ARRAY' THEN lpad(je.key, 12, '0')
                                      ELSE je.key END) - 1 AS idx, je.value AS item
           FROM json_each(it2.item) je) s
  WHERE json_type(s.item) IN ('OBJECT', 'ARRAY') AND json_extract(s.item, '$.url') IS NOT NULL),
objs AS (SELECT * FROM single UNION ALL SELECT * FROM item_obj UNION ALL SELECT * FROM sub_obj),
r AS (SELECT page_id, path, f, i, j, json_extract_string(obj, '$.url') AS src,
        TRY_CAST(json_extract(obj, '$.id') AS BIGINT) AS image_id, json_extract_string(obj, '$.alt') AS obj_alt
      FROM objs WHERE NOT {falsy_sql("json_extract_string(obj, '$.url')")}),
j AS (SELECT r.*, a.alt AS att_alt, CAST(a.width AS VARCHAR) AS att_w, CAST(a.height AS VARCHAR) AS att_h,
        r.image_id IS NOT NULL AND r.image_id <> 0 AS has_id
      FROM r LEFT JOIN attachments a ON a.id = r.image_id),
k AS (SELECT *, CASE WHEN has_id THEN coalesce(att_alt, '') ELSE '' END AS alt0 FROM j)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY path, f, i, j) AS BIGINT) AS pos, src,
  CASE WHEN {falsy_sql('alt0')} AND obj_alt IS NOT NULL THEN obj_alt ELSE alt0 END AS alt,
  CASE WHEN has_id THEN coalesce(att_w, '') ELSE '' END AS width,
  CASE WHEN has_id THEN coalesce(att_h, '') ELSE '' END AS height, '' AS loading,
  NOT {falsy_sql("CASE WHEN " + falsy_sql('alt0') + " AND obj_alt IS NOT NULL THEN obj_alt ELSE alt0 END")} AS has_alt,
  false AS has_lazy_loading, 'elementor' AS source
FROM k""", views=("builder_trees", "attachments"))
def tree_images(t):
    """Builder images of every page: 13 image settings + background, attachment alt/size."""
    return TR.tree_images(TR.tree_nodes(t.builder_trees), t.attachments)


def _cand(k, tag, field, min_len, cond) -> str:
    raw = f"CASE WHEN json_type(json_extract(settings, '$.\"{field}\"')) = 'VARCHAR' THEN json_extract_string(settings, '$.\"{field}\"') END"
    txt = strip_sql(raw)
    return (f"SELECT page_id, path, {k} AS k, {tag} AS tag, trim({txt}) AS text FROM nd WHERE {cond} "
            f"AND NOT {falsy_sql(raw)} AND NOT {falsy_sql(txt)} AND strlen({txt}) >= {min_len}")


_HDR = ("CASE WHEN json_extract(settings, '$.header_size') IS NULL OR json_type(json_extract(settings, '$.header_size')) = 'NULL' "
        "THEN 'h2' ELSE lower(CASE WHEN json_type(json_extract(settings, '$.header_size')) = 'VARCHAR' "
        "THEN json_extract_string(settings, '$.header_size') END) END")


@query("tree_blocks", oracle=f"""WITH {NODES_SQL},
c AS ({_cand(0, _HDR, 'title', 10, "widgetType = 'heading'")}
  UNION ALL {_cand(1, "'h3'", 'title_text', 5, "widgetType IN ('icon-box', 'image-box')")}
  UNION ALL {_cand(2, "'p'", 'description_text', 20, "widgetType IN ('icon-box', 'image-box')")}
  UNION ALL {_cand(3, "'h3'", 'title', 5, "widgetType = 'call-to-action'")}
  UNION ALL {_cand(4, "'p'", 'description', 20, "widgetType = 'call-to-action'")}
  UNION ALL {_cand(5, "'p'", 'text', 20, "widgetType = 'text'")}
  UNION ALL {_cand(6, "'p'", 'description', 20, "widgetType = 'text'")}
  UNION ALL {_cand(7, "'p'", 'testimonial_content', 20, "widgetType = 'testimonial'")}
  UNION ALL {_cand(8, "'p'", 'blockquote_content', 20, "widgetType = 'blockquote'")}),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, regexp_replace(text, '[^a-z0-9]+', '', 'g')
                                                 ORDER BY path, k) AS rn FROM c) WHERE rn = 1)
SELECT page_id, CAST(pos AS INTEGER) AS pos, tag, text FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY path, k) AS pos FROM d)
""", views=("builder_trees",))
def tree_blocks(t):
    """Content blocks from builder widgets (heading, boxes, CTA, text widgets), dedup."""
    return TR.tree_blocks(TR.tree_nodes(t.builder_trees))


@query("widget_compat", oracle=f"""WITH {NODES_SQL},
caps AS (SELECT site_id,
  bool_or(contains(path, 'royal-elementor-addons') OR contains(path, 'wpr-addons')) AS royal,
  bool_or(contains(path, 'pro-elements') OR contains(path, 'proelements')) AS pro_el,
  bool_or(contains(path, 'elementor-pro/elementor-pro.php')) AS epro
  FROM (SELECT DISTINCT site_id, path FROM site_plugins) GROUP BY site_id),
pp AS (SELECT page_id, site_id, bool_or(starts_with(coalesce(widgetType, ''), 'wpr-')) AS has_wpr,
  bool_or(coalesce(widgetType, '') IN ({", ".join(f"'{w}'" for w in TR.PRO_WIDGETS)})) AS has_pro
  FROM nd GROUP BY page_id, site_id)
SELECT pp.page_id, has_wpr, has_pro, has_wpr AND NOT coalesce(royal, false) AS wpr_warning,
  has_pro AND NOT (coalesce(epro, false) OR coalesce(pro_el, false)) AS pro_warning
FROM pp LEFT JOIN caps ON caps.site_id = pp.site_id""", views=("builder_trees", "site_plugins"))
def widget_compat(t):
    """Per builder page: wpr-*/pro widgets used and warnings when the addon is inactive."""
    nodes = TR.tree_nodes(t.builder_trees, keep=("site_id",))
    return TR.widget_compat(nodes, S.plugin_capabilities(t.site_plugins))


@query("tree_set_h1", oracle=f"""WITH {NODES_SQL},
h AS (SELECT page_id, path, CASE WHEN json_extract(settings, '$.header_size') IS NULL
        OR json_type(json_extract(settings, '$.header_size')) = 'NULL' THEN 'h2'
        WHEN json_type(json_extract(settings, '$.header_size')) = 'VARCHAR'
        THEN json_extract_string(settings, '$.header_size') END AS hs
      FROM nd WHERE widgetType = 'heading'),
pp AS (SELECT DISTINCT page_id FROM builder_trees),
a AS (SELECT pp.page_id, min(h.path) FILTER (WHERE h.hs = 'h1') AS p1,
        min(h.path) FILTER (WHERE h.hs IN ('h2', 'h3')) AS p23 FROM pp LEFT JOIN h ON h.page_id = pp.page_id
      GROUP BY pp.page_id)
SELECT a.page_id, CASE WHEN p1 IS NOT NULL THEN 'updated' WHEN p23 IS NOT NULL THEN 'converted_from_h2'
  ELSE 'created' END AS action, array_to_string(coalesce(p1, p23), '.') AS target_path,
  'New title ' || a.page_id AS h1_title,
  (SELECT count(*) FROM nodes WHERE nodes.page_id = a.page_id) + CASE WHEN coalesce(p1, p23) IS NULL THEN 3 ELSE 0 END AS n_nodes
FROM a
""", views=("builder_trees",))
def tree_set_h1(t):
    """A new H1 title set in every builder tree: what was done, and title and size of the rewritten tree."""
    trees = t.builder_trees
    titles = trees.select("page_id", F.concat(F.lit("New title "), F.col("page_id").cast("string")).alias("title"))
    new = TR.tree_set_h1(trees, titles)
    nodes = TR.tree_nodes(new)
    is_h1 = (F.col("widgetType") == "heading") & (TR.vstring(TR.setting("header_size")) == "h1")
    seen = nodes.groupBy("page_id").agg(F.min_by(TR.vstring(TR.setting("title")), F.when(is_h1, F.col("path"))).alias("h1_title"),
                                        F.count(F.lit(1)).alias("n_nodes"))
    return new.select("page_id", "action", "target_path").join(seen, "page_id")
