"""Derived input views: one SQL text each, run unchanged by Spark and DuckDB.

They only reshape the given tables into the record shapes the operators
consume (posts, postmeta, builder trees, publish logs, ...). They do none of
an operator's work; every operator is written for any data of the schema.
Portable subset: no backslashes in literals, STRING/BIGINT casts,
INTERVAL '1' HOUR * n, %, concat, replace, md5. See FIXTURES.md.
"""

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["posts"] = """
SELECT page_id AS id, page_id % 5 AS site_id,
  CASE WHEN page_id % 3 = 0 THEN 'post' ELSE 'page' END AS post_type,
  CASE page_id % 10 WHEN 9 THEN 'draft' WHEN 8 THEN 'private' ELSE 'publish' END AS post_status,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS post_title,
  concat('slug-', CAST(page_id % 37 AS STRING)) AS post_name,
  html AS post_content,
  CASE WHEN page_id % 4 = 0 THEN concat('Excerpt ', CAST(page_id AS STRING)) ELSE '' END AS post_excerpt,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * page_id AS post_date,
  TIMESTAMP '2024-02-01 00:00:00' + INTERVAL '1' HOUR * ((page_id * 7) % 251) AS post_modified,
  page_id % 10 AS post_author, page_id % 7 AS menu_order, url
FROM pages
"""

FIXTURE_SQL["enriched_pages"] = """
SELECT page_id, url, replace(html, '</article>', concat(
  '<h2 class="x">Second heading ', CAST(page_id % 5 AS STRING), '</h2>',
  '<h3>Our <em>location</em> ', CAST(page_id AS STRING), '</h3>',
  '<img data-src="/lazy', CAST(page_id AS STRING), '.jpg" src="/img', CAST(page_id AS STRING), '.jpg" alt="',
  CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE 'Photo' END, '" width="640" height="480" loading="lazy">',
  '<IMG src="/b.png">',
  '<a href="https://other.example.com/p', CAST(page_id AS STRING), '">Out <b>side</b></a>',
  '<a href="#top">top</a><a href="mailto:a@example.com">mail</a><a href="//cdn.example.com/x">cdn</a>',
  '<!-- ECHO5:START HERO --><p>Hero section text number ', CAST(page_id AS STRING), '</p><!-- ECHO5:END HERO -->',
  '<script type="application/ld+json">{"@type":"Article","id":', CAST(page_id AS STRING), '}</script>',
  CASE WHEN page_id % 4 = 0 THEN '<script type="application/ld+json">{bad</script>' ELSE '' END,
  '</article>')) AS html
FROM pages
"""

FIXTURE_SQL["postmeta"] = """
SELECT page_id * 10 + 1 AS meta_id, page_id AS post_id, '_yoast_wpseo_title' AS meta_key,
  CASE page_id % 3 WHEN 0 THEN '%%title%%' WHEN 1 THEN concat('SEO ', CAST(page_id AS STRING)) ELSE '' END AS meta_value FROM pages
UNION ALL SELECT page_id * 10 + 2, page_id, '_yoast_wpseo_metadesc', concat('Description of ', CAST(page_id AS STRING)) FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id * 10 + 3, page_id, 'rank_math_title', concat('RM ', CAST(page_id AS STRING)) FROM pages WHERE page_id % 5 = 1
UNION ALL SELECT page_id * 10 + 4, page_id, 'rank_math_focus_keyword', 'alpha' FROM pages WHERE page_id % 5 = 1
UNION ALL SELECT page_id * 10 + 5, page_id, '_aioseo_title', CASE WHEN page_id % 2 = 0 THEN '#post_title' ELSE 'AIO' END FROM pages WHERE page_id % 5 = 2
UNION ALL SELECT page_id * 10 + 6, page_id, '_thumbnail_id', CAST(page_id + 100000 AS STRING) FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id * 10 + 7, page_id, '_echo5_seo_managed', '1' FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id * 10 + 8, page_id, '_yoast_wpseo_title', 'duplicate, later meta_id' FROM pages WHERE page_id % 6 = 1
UNION ALL SELECT page_id * 10 + 9, page_id, '_et_pb_post_content', concat('<p>Module text ', CAST(page_id AS STRING), '</p>') FROM pages WHERE page_id % 4 = 1
UNION ALL SELECT page_id * 10, page_id, '_wp_page_template', CASE WHEN page_id % 8 = 2 THEN 'templates/wide.php' ELSE '' END FROM pages WHERE page_id % 4 = 2
"""

FIXTURE_SQL["site_plugins"] = """
SELECT * FROM (VALUES
  (0, 'wordpress-seo/wp-seo.php', 'yoast', '22.0'), (0, 'elementor/elementor.php', NULL, '3.20'),
  (1, 'seo-by-rank-math/rank-math.php', 'rankmath', '1.0'), (1, 'royal-elementor-addons/wpr-addons.php', NULL, '1.3'),
  (2, 'all-in-one-seo-pack/all_in_one_seo_pack.php', 'aioseo', '4.5'), (2, 'pro-elements/pro-elements.php', NULL, '3.20'),
  (3, 'wordpress-seo/wp-seo.php', 'yoast', '22.0'), (3, 'seo-by-rank-math/rank-math.php', 'rankmath', '1.0')
) AS t(site_id, path, plugin, version)
UNION ALL SELECT s_suppkey + 10,
  CASE s_suppkey % 6 WHEN 0 THEN 'wordpress-seo/wp-seo.php' WHEN 1 THEN 'seo-by-rank-math/rank-math.php' WHEN 2 THEN 'all-in-one-seo-pack/all_in_one_seo_pack.php'
    WHEN 3 THEN 'wp-seopress/seopress.php' WHEN 4 THEN 'autodescription/autodescription.php' ELSE concat('own-', CAST(s_suppkey AS STRING), '/own.php') END,
  CASE s_suppkey % 6 WHEN 0 THEN 'yoast' WHEN 1 THEN 'rankmath' WHEN 2 THEN 'aioseo' WHEN 3 THEN 'seopress' WHEN 4 THEN 'tsf' END,
  CASE WHEN s_suppkey % 7 = 3 THEN '' ELSE concat('2', CAST(s_suppkey % 5 AS STRING), '.1') END
FROM supplier
UNION ALL SELECT s_suppkey + 10, CASE s_suppkey % 4 WHEN 0 THEN 'elementor/elementor.php' WHEN 1 THEN 'royal-elementor-addons/wpr-addons.php'
  WHEN 2 THEN 'elementor-pro/elementor-pro.php' ELSE 'pro-elements/pro-elements.php' END, NULL, '3.20' FROM supplier WHERE s_suppkey % 3 > 0
"""

FIXTURE_SQL["attachments"] = """
SELECT page_id + 100000 AS id, concat('https://cdn.example.com/img', CAST(page_id AS STRING), '.jpg') AS source_url,
  md5(concat('https://cdn.example.com/img', CAST(page_id AS STRING), '.jpg')) AS url_hash,
  CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('Alt ', CAST(page_id AS STRING)) END AS alt,
  CASE WHEN page_id % 4 = 0 THEN NULL ELSE 800 END AS width, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 600 END AS height,
  CASE page_id % 5 WHEN 0 THEN 'image/svg+xml' WHEN 1 THEN 'image/png' ELSE 'image/jpeg' END AS mime_type,
  CASE page_id % 25 WHEN 0 THEN 'FFD8FFE000104A464946' WHEN 5 THEN '89504e470d0a1a0a0000' WHEN 10 THEN '52494646240000005745425056503820'
    WHEN 15 THEN '474946383961' WHEN 20 THEN '3C737667' END AS head_hex,
  CASE WHEN page_id % 6 = 0 THEN 11000000 ELSE 50000 END AS n_bytes,
  CASE WHEN page_id % 2 = 0 THEN page_id ELSE 0 END AS post_parent, page_id % 4 <> 3 AS uploaded_by_us,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '6' HOUR * page_id AS post_date
FROM pages
"""

FIXTURE_SQL["builder_trees"] = """
SELECT page_id, page_id % 5 AS site_id, page_id % 7 AS menu_order, concat(
  '[{"id":"s', CAST(page_id AS STRING), '","elType":"section","settings":{"background_color":"#', CASE page_id % 3 WHEN 0 THEN 'abc' WHEN 1 THEN '1A2B3C' ELSE 'aabbcd' END,
  '","padding":{"top":"', CAST(page_id % 40 AS STRING), '","unit":"px"}},"elements":[{"id":"c","elType":"column","settings":{"_column_size":100},"elements":[',
  '{"id":"w1","elType":"widget","widgetType":"heading","settings":{"title":"Heading <b>number</b> ', CAST(page_id AS STRING), '"',
  CASE page_id % 3 WHEN 0 THEN ',"header_size":"h1"' WHEN 1 THEN '' ELSE ',"header_size":"h4"' END,
  ',"title_color":"rgb(', CAST(page_id % 256 AS STRING), ', 10, 300)","typography_typography":"custom","typography_font_family":"Roboto"},"elements":[]},',
  '{"id":"w2","elType":"widget","widgetType":"', CASE page_id % 4 WHEN 0 THEN 'wpr-grid' WHEN 1 THEN 'price-table' ELSE 'icon-box' END,
  '","settings":{"title_text":"Fast help","description_text":"A description that is long enough","items":[{"text":"one","n":1},{"text":"two"}]},"elements":[]},',
  '{"id":"w3","elType":"widget","widgetType":"image","settings":{"image":{"url":"/i', CAST(page_id AS STRING), '.png","id":', CAST(page_id + 100000 AS STRING),
  ',"alt":"w"},"gallery":[{"url":"/g1.png"},{"pic":{"url":"/g2.png"}}]},"elements":[]}]}]}]') AS tree_json
FROM pages
"""

FIXTURE_SQL["publish_logs"] = """
SELECT event_id AS id, md5(concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING))) AS correlation_id,
  CASE event_type WHEN 'purchase' THEN 'publish_success' WHEN 'error' THEN 'publish_error' WHEN 'signup' THEN 'rollback_success'
    WHEN 'click' THEN 'schedule_success' ELSE 'publish_start' END AS action,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' ELSE 'info' END AS status,
  user_id AS page_id, concat('slug-', CAST(user_id AS STRING)) AS page_slug,
  concat('10.', CAST(user_id % 4 AS STRING), '.', CAST(user_id % 16 AS STRING), '.', CAST(user_id % 250 AS STRING)) AS user_ip,
  CASE WHEN event_id % 5 = 0 THEN concat('{"authorization":{"bearer":"b', CAST(event_id AS STRING), '"},"slug":"s","token":["t",1],"secret":2}')
    ELSE concat('{"API_Key":"k', CAST(event_id AS STRING), '","slug":"s"}') END AS request_data,
  CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN '{"action":"created"}' ELSE '{"action":"updated"}' END END AS response_data,
  CASE WHEN event_type = 'error' THEN concat('E', CAST(event_id % 7 AS STRING)) END AS error_message,
  CASE WHEN event_type <> 'view' THEN CAST(floor(value * 10) AS INT) END AS response_time_ms,
  ts AS created_at
FROM events
"""

FIXTURE_SQL["access_log"] = """
SELECT event_id, ts, event_type = 'error' AS failed,
  CASE WHEN event_id % 3 = 0 THEN concat('192.168.', CAST(user_id % 8 AS STRING), '.', CAST(user_id % 250 AS STRING)) END AS cf_ip,
  CASE WHEN event_id % 5 = 0 THEN 'not-an-ip' END AS real_ip,
  CASE WHEN event_id % 2 = 0 THEN concat('10.0.0.', CAST(user_id % 250 AS STRING), ', 172.16.0.1') END AS forwarded_for,
  concat('203.0.113.', CAST(user_id % 8 AS STRING)) AS remote_addr,
  ts + INTERVAL '1' SECOND * ((event_id * 37) % 700 - 350) AS signed_at,
  concat('key-', CAST(event_id % 400 AS STRING)) AS idempotency_key
FROM events
"""

FIXTURE_SQL["whitelist"] = """
SELECT * FROM (VALUES ('192.168.1.0/24'), ('10.0.0.0/28'), ('203.0.113.7'), ('192.168.4.0/30')) AS t(entry)
"""

FIXTURE_SQL["page_versions"] = """
SELECT conv_id AS page_id, 1700000000 + turn AS version, text AS content, concat('Title ', CAST(turn AS STRING)) AS post_title,
  CASE WHEN turn % 2 = 0 THEN concat('{"_yoast_wpseo_title":"v', CAST(turn AS STRING), '"}') END AS seo_meta_json,
  turn % 5 = 4 AS legacy_format
FROM conversations
"""

FIXTURE_SQL["publish_requests"] = """
SELECT doc_id AS request_id, concat('slug-', CAST(doc_id % 60 AS STRING)) AS slug,
  substr(replace(text, ' ', '-'), 1, CAST(doc_id % 80 AS INT)) AS title,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE concat('slug-', CAST((doc_id * 3) % 50 AS STRING)) END AS parent_slug,
  CASE WHEN doc_id % 2 = 0 THEN 'safe' ELSE 'full' END AS update_mode,
  CASE WHEN doc_id % 4 = 0 THEN concat('<!-- ECHO5:START HERO --><h1>New ', CAST(doc_id AS STRING), ' costs $1</h1><!-- ECHO5:END HERO --><p>', text, '</p>')
       ELSE concat('<p>', text, '</p>') END AS html,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE substr(replace(text, ' ', '-'), 1, CAST(doc_id % 200 AS INT)) END AS meta_description,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'keyword' END AS focus_keyword,
  CASE WHEN doc_id % 6 = 0 THEN '{"service":{"@type":"Service"},"faqpage":null}' END AS schema_json,
  CASE WHEN doc_id % 7 = 0 THEN concat('https://example.com/c', CAST(doc_id AS STRING)) ELSE '' END AS canonical,
  CASE WHEN doc_id % 4 = 1 THEN concat('OG ', CAST(doc_id AS STRING)) END AS og_title,
  CASE WHEN doc_id % 4 IN (1, 2) THEN concat('OG text ', CAST(doc_id AS STRING)) ELSE '' END AS og_description,
  CASE WHEN doc_id % 3 = 1 THEN '/og.png' END AS og_image,
  CASE WHEN doc_id % 8 = 1 THEN concat('TW ', CAST(doc_id AS STRING)) END AS twitter_title,
  CASE WHEN doc_id % 16 = 2 THEN concat('TW text ', CAST(doc_id AS STRING)) ELSE '0' END AS twitter_description,
  CASE WHEN doc_id % 5 IN (2, 3) THEN concat('["second ', CAST(doc_id AS STRING), '","third"]') WHEN doc_id % 5 = 4 THEN '[]' END AS secondary_json,
  CASE doc_id % 3 WHEN 0 THEN 'publish' WHEN 1 THEN 'draft' ELSE 'private' END AS status,
  CASE WHEN doc_id % 4 = 3 THEN 'elementor_canvas' ELSE '' END AS template, doc_id % 6 = 5 AS hide_title,
  CASE WHEN doc_id % 9 = 4 THEN concat('h1{margin:', CAST(doc_id AS STRING), 'px}') END AS custom_css,
  CASE WHEN doc_id % 2 = 0 THEN concat('https://cdn.example.com/img', CAST(doc_id % 400 AS STRING), '.jpg') END AS featured_url,
  TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '1' MINUTE * (doc_id - doc_id % 120 + doc_id % 60) + INTERVAL '0.4' SECOND * (CASE WHEN doc_id % 120 < 60 THEN 0 ELSE 1 END) AS requested_at
FROM documents
"""

FIXTURE_SQL["menu_items"] = """
SELECT p_partkey AS id, p_type AS menu, p_name AS title, concat('/', p_brand) AS url, p_partkey % 7 AS parent_id, p_size AS menu_order FROM part
"""

FIXTURE_SQL["users"] = """
SELECT s_suppkey AS id, s_name AS display_name, lower(s_name) AS login, concat(lower(s_name), '@example.com') AS email FROM supplier
"""

FIXTURE_SQL["terms"] = """
SELECT CAST(n_nationkey AS BIGINT) AS term_id, CASE WHEN n_nationkey % 2 = 0 THEN 'category' ELSE 'post_tag' END AS taxonomy, n_name AS name, lower(n_name) AS slug FROM nation
"""

FIXTURE_SQL["term_relationships"] = """
SELECT page_id AS post_id, page_id % 25 AS term_id FROM pages UNION ALL SELECT page_id, (page_id * 3 + 1) % 25 FROM pages
"""

FIXTURE_SQL["kit_settings"] = """
SELECT site_id, concat('{"system_colors":[{"_id":"primary","color":"#1A2B3C","title":"Primary"},{"_id":"text","color":"#111111","title":"Text"}],',
  '"custom_colors":[{"_id":"c', CAST(site_id AS STRING), '","color":"#AABBCC"}],',
  '"system_typography":[{"_id":"primary","title":"Primary","typography_font_family":"Roboto","typography_font_weight":"600"}],"button_text_color":"#FFFFFF"}') AS settings_json
FROM (SELECT DISTINCT page_id % 4 AS site_id FROM pages) s
"""

FIXTURE_SQL["blog_requests"] = """
SELECT doc_id AS request_id,
  CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('Post ', CAST(doc_id AS STRING)) END AS title,
  CASE WHEN doc_id % 13 = 0 THEN '' ELSE concat('<p>', text, '</p>',
    CASE WHEN doc_id % 2 = 0 THEN '<!-- image:1 --><p>middle</p><!-- image:2 --><!-- image:3 -->' ELSE '<!-- image:1 -->' END) END AS content,
  CASE doc_id % 4 WHEN 0 THEN 'draft' WHEN 1 THEN 'publish' WHEN 2 THEN 'pending' ELSE '' END AS status,
  CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'algeria' WHEN 2 THEN 'nowhere' ELSE 'brazil' END AS category_slug,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('SUPPLIER#', lpad(CAST(doc_id % 150 AS STRING), 9, '0')) END AS author_name,
  CASE WHEN doc_id % 2 = 0 THEN concat('slug-', CAST(doc_id % 50 AS STRING)) ELSE concat('new-', CAST(doc_id AS STRING)) END AS slug,
  concat('[{"url":"https://cdn.example.com/in', CAST(doc_id AS STRING), '.jpg","alt":"First ', CAST(doc_id % 9 AS STRING),
    '"},{"url":"","alt":"none"},{"url":"https://cdn.example.com/x.png","alt":"Third"}]') AS inline_images_json,
  doc_id % 3 = 0 AS featured_is_first_inline,
  TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '1' MINUTE * doc_id AS requested_at
FROM documents
"""

FIXTURE_SQL["schedule_requests"] = """
SELECT doc_id AS request_id, concat('slug-', CAST(doc_id % 60 AS STRING)) AS slug,
  CASE WHEN doc_id % 10 = 0 THEN 'soon' WHEN doc_id % 10 = 1 THEN NULL
       ELSE CAST(TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '1' HOUR * (doc_id % 97) AS STRING) END AS publish_at,
  TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '1' MINUTE * doc_id AS requested_at
FROM documents
"""

FIXTURE_SQL["flat_builder"] = """
SELECT page_id, CASE WHEN page_id % 3 = 1 THEN '[]' ELSE concat('[{"node":"a","settings":{"heading":"Flat heading ', CAST(page_id AS STRING),
  '","text":"<p>Flat body text</p>","photo":', CAST(page_id + 100000 AS STRING), '}},',
  '{"node":"b","settings":{"title":"', CASE WHEN page_id % 2 = 0 THEN '' ELSE 'Second' END,
  '","bg_image":"https://cdn.example.com/bg', CAST(page_id AS STRING), '.jpg","image":"not a url","btn_text":"Go"}}]') END AS flat_json
FROM pages
"""

# Base tables each view reads (registered as temp views before it runs).
VIEW_DEPS: dict[str, tuple[str, ...]] = {
    "posts": ('pages',),
    "enriched_pages": ('pages',),
    "postmeta": ('pages',),
    "site_plugins": ('supplier',),
    "attachments": ('pages',),
    "builder_trees": ('pages',),
    "publish_logs": ('events',),
    "access_log": ('events',),
    "whitelist": (),
    "page_versions": ('conversations',),
    "publish_requests": ('documents',),
    "menu_items": ('part',),
    "users": ('supplier',),
    "terms": ('nation',),
    "term_relationships": ('pages',),
    "kit_settings": ('pages',),
    "blog_requests": ('documents',),
    "schedule_requests": ('documents',),
    "flat_builder": ('pages',),
}


def with_views(body: str, *names: str) -> str:
    """Prefix an oracle query with the views it reads as a WITH clause."""
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n]}\n)" for n in names)
    head = body.lstrip()
    if head[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{head[15:]}"
    if head[:5].upper() == "WITH ":
        # The body has its own CTEs: append them after the views.
        return f"WITH {ctes},\n{head[5:]}"
    return f"WITH {ctes}\n{body}"
