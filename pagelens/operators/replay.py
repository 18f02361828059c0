"""Replay of a batch of publish requests: every request counts, none is applied one by one.

A request merges sections into a page or replaces it, sets and appends to meta values, and saves
a version of what was there before. Of a page only the newest KEPT_VERSIONS saves survive, so a
page's requests fall into at most KEPT_VERSIONS + 1 stretches between those saves. What a stretch
does is one aggregate (last whole html, newest text of each section, last value set, values
appended since); a fold over a page's few stretches then gives the text and the meta values before every kept save
and after the last request. A page that a third of all requests update is reduced by partial
aggregates; no window or list ever spans a page's requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.common import falsy
from pagelens.operators.publish import batch_updates, fold_sections, wrap_content
from pagelens.operators.seo import GENERIC, META_KEYS, load_postmeta
from pagelens.operators.versions import SNAPSHOT_META_KEYS, VERSION_COUNT_KEY

#: Versions that cleanup leaves: ten keys by name, of which the version count is one.
KEPT_VERSIONS = 9
# The key that RankMath keeps all keywords in; meta keys that publishing sets.
APPENDED_KEY = "rank_math_focus_keyword"
#: Ids of pages that the batch creates start here, plus the first request's id.
NEW_ID = 1_000_000_000_000


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _ops(rows: DataFrame, writes: list[tuple[Column, Column, str, Column]]) -> DataFrame:
    """(post_id, request_id, requested_at, step, meta_key, op, value) of the writes whose condition holds and whose key is known."""
    cells = F.array(*[F.struct((on & key.isNotNull()).alias("on"), key.alias("meta_key"), F.lit(op).alias("op"), value.cast("string").alias("value")) for on, key, op, value in writes])
    cells = F.filter(cells, lambda x: x["on"])
    return rows.select("post_id", "request_id", "requested_at", F.posexplode(cells).alias("step", "_x")).select(
        "post_id", "request_id", "requested_at", "step", "_x.meta_key", "_x.op", "_x.value")


def seo_ops(requests: DataFrame, active: DataFrame) -> DataFrame:
    """What every request writes to the meta of its page (``post_id``), in order of ``step``: ``set`` or ``append``.

    Fields that are given go to the active plugin's key and to the backup key; the description also becomes the excerpt;
    secondary keywords are kept as a list and, for RankMath, appended to the keywords; Open Graph fields are written
    if title or description is given, Twitter's fall back to them; managed flag, time and plugin are recorded.
    ``secondary_keywords`` is an array. Pages without a known site use the generic keys.
    """
    table = [x for p, pairs in META_KEYS.items() for f, k in pairs for x in (F.lit(f"{p}|{f}"), F.lit(k))]
    keys = F.create_map(*table)
    r = requests.join(active.select(F.col("id").alias("post_id"), "seo_plugin"), "post_id", "left").withColumn("seo_plugin", F.coalesce("seo_plugin", F.lit(GENERIC)))
    key = lambda f: F.try_element_at(keys, F.concat("seo_plugin", F.lit(f"|{f}")))
    given = lambda c: ~falsy(F.col(c))
    og = given("og_title") | given("og_description")
    listed = F.size(F.coalesce("secondary_keywords", F.array())) > 0
    own = lambda c, other: F.when(given(c), F.col(c)).when(given(other), F.col(other))
    writes = []
    for field, c, backup in (("title", "meta_title", "_echo5_seo_title"), ("description", "meta_description", "_echo5_seo_description"), ("focus_keyword", "focus_keyword", "_echo5_focus_keyword")):
        writes += [(given(c), key(field), "set", F.col(c)), (given(c), F.lit(backup), "set", F.col(c))]
    writes += [(given("meta_description"), F.lit("post_excerpt"), "set", F.col("meta_description")),
               (listed & (F.col("seo_plugin") == "rankmath"), F.lit(APPENDED_KEY), "append", F.array_join("secondary_keywords", ",")),
               (listed, F.lit("_echo5_secondary_keywords"), "set", F.to_json("secondary_keywords")),
               (given("canonical"), key("canonical"), "set", F.col("canonical")), (given("canonical"), F.lit("_echo5_canonical"), "set", F.col("canonical"))]
    writes += [(og & given(c), key(c), "set", F.col(c)) for c in ("og_title", "og_description", "og_image")]
    for c, other in (("twitter_title", "og_title"), ("twitter_description", "og_description")):
        writes.append((og & own(c, other).isNotNull(), key(c), "set", own(c, other)))
    always = F.lit(True)
    writes += [(always, F.lit("_echo5_seo_managed"), "set", F.lit("1")), (always, F.lit("_echo5_seo_updated"), "set", stamp(F.col("requested_at"))),
               (always, F.lit("_echo5_seo_plugin_used"), "set", F.col("seo_plugin"))]
    return _ops(r, writes)


def publish_ops(requests: DataFrame) -> DataFrame:
    """What publishing itself writes to a page's meta: managed flag, time, mode, schemas, template, hidden title, own CSS, thumbnail."""
    given = lambda c: ~falsy(F.col(c))
    always, hide = F.lit(True), F.coalesce("hide_title", F.lit(False))
    schema = given("schema_json") & ~F.col("schema_json").isin("{}", "[]", "null")
    return _ops(requests, [
        (F.col("thumbnail_id").isNotNull(), F.lit("_thumbnail_id"), "set", F.col("thumbnail_id")),
        (always, F.lit("_echo5_managed"), "set", F.lit("1")), (always, F.lit("_echo5_last_sync"), "set", stamp(F.col("requested_at"))),
        (always, F.lit("_echo5_update_mode"), "set", F.col("update_mode")), (schema, F.lit("_echo5_structured_data"), "set", F.col("schema_json")),
        (schema, F.lit("_echo5_schemas"), "set", F.col("schema_json")), (given("template"), F.lit("_wp_page_template"), "set", F.col("template")),
        (hide, F.lit("_echo5_hide_title"), "set", F.lit("1")), (given("custom_css"), F.lit("_echo5_custom_css"), "set", F.col("custom_css"))])


def composed(ops: DataFrame, by: list[str]) -> DataFrame:
    """Per group what its operations amount to: ``_set`` (last value set, as a struct; null: none) and ``_added`` (null or what was
    appended since: ``all`` for a value that is there, ``alone`` for a falsy one, which an append replaces).

    The appended values of a group are one text by definition; of those before the last ``set`` nothing is kept.
    """
    at = F.struct("requested_at", "request_id", "step")
    sets = F.max(F.when(F.col("op") == "set", F.struct(at.alias("at"), F.col("value").alias("v"))))
    adds = F.collect_list(F.when(F.col("op") == "append", F.struct(at.alias("at"), F.col("value").alias("v"))))
    rows = ops.groupBy(*by).agg(sets.alias("_s"), adds.alias("_adds"))
    late = F.filter(F.array_sort("_adds"), lambda x: F.col("_s").isNull() | (x["at"] > F.col("_s.at")))
    return rows.select(*by, F.when(F.col("_s").isNotNull(), F.struct(F.col("_s.v").alias("v"))).alias("_set"), F.when(F.size(late) > 0, F.struct(
        F.array_join(F.transform(late, lambda x: x["v"]), ",").alias("all"),
        F.aggregate(late, F.lit("").cast("string"), lambda a, x: F.when(falsy(a), x["v"]).otherwise(F.concat(a, F.lit(","), x["v"]))).alias("alone"))).alias("_added"))


def _applied(old: Column, given: Column, added: Column) -> Column:
    base = F.when(given.isNotNull(), given["v"]).otherwise(old)
    return F.when(added.isNull(), base).when(falsy(base), added["alone"]).otherwise(F.concat(base, F.lit(","), added["all"]))


def apply_ops(ops: DataFrame, postmeta: DataFrame) -> DataFrame:
    """``post_id, meta_key, meta_value`` of every key that the operations write, after the last of them."""
    done = composed(ops, ["post_id", "meta_key"])
    old = load_postmeta(postmeta, [APPENDED_KEY]).withColumnRenamed("meta_value", "_old")  # appends need what was there
    done = done.join(old, ["post_id", "meta_key"], "left")
    return done.select("post_id", "meta_key", _applied(F.col("_old"), F.col("_set"), F.col("_added")).alias("meta_value"))


def saves(requests: DataFrame) -> DataFrame:
    """Versions that the batch saves, one per page and second: ``slug, version, cut, n_saves, newest``.

    ``requests`` has slug, request_id, requested_at and post_id (null: the first request creates the page and saves nothing).
    ``cut`` is the last request of the second, whose state before it the version holds; ``newest`` numbers a page's versions from the latest.
    """
    at = F.struct("requested_at", "request_id")
    rows = requests.select("slug", "post_id", at.alias("_at"), F.unix_timestamp(F.col("requested_at").cast("timestamp")).alias("version"))
    first = rows.groupBy("slug").agg(F.min("_at").alias("_first"))
    rows = rows.join(first, "slug").filter(F.col("post_id").isNotNull() | (F.col("_at") > F.col("_first")))
    seconds = rows.groupBy("slug", "version").agg(F.max("_at").alias("cut"), F.count(F.lit(1)).alias("n_saves"))
    return seconds


def newest(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of each key with the greatest version; Spark limits every task's rows of a key before they are shuffled."""
    w = Window.partitionBy(key).orderBy(F.col("version").desc())
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def _stretched(requests: DataFrame, cuts: DataFrame) -> DataFrame:
    """The requests with ``stretch``, the number of kept saves up to and with them."""
    at = F.struct("requested_at", "request_id")
    per_slug = cuts.groupBy("slug").agg(F.array_sort(F.collect_list("cut")).alias("_cuts"))  # KEPT_VERSIONS at most
    return requests.join(per_slug, "slug", "left").withColumn("stretch", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= at)), F.lit(0))).withColumn(
        "stretch", F.greatest("stretch", F.lit(0))).drop("_cuts")


def replayed_pages(requests: DataFrame, posts: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per slug the last request's fields, ``first_request``, ``existing`` (html before the batch) and ``states``: (stretch, html, post_title) after each stretch.

    ``requests`` is as for ``saves``, with html, update_mode and title.
    """
    parts = batch_updates(_stretched(requests, cuts), by=("slug", "stretch"))
    fields = [c for c in requests.columns if c not in ("slug", "html")]
    part = F.struct("stretch", F.struct(*fields).alias("last"), "base_html", "first_html", "sections", "first_request")
    rows = parts.groupBy("slug").agg(F.array_sort(F.collect_list(part), lambda a, b: a["stretch"] - b["stretch"]).alias("_parts"))  # KEPT_VERSIONS + 1 at most
    rows = rows.withColumn("post_id", F.element_at("_parts", -1)["last"]["post_id"])
    rows = rows.join(posts.select(F.col("id").alias("post_id"), F.col("post_content").alias("existing"), F.col("post_title").alias("_old_title")), "post_id", "left")
    none = F.array().cast("array<struct<stretch:int,html:string,post_title:string>>")
    start = F.struct(F.col("existing").alias("now"), none.alias("out"))

    def step(s: Column, p: Column) -> Column:
        now = fold_sections(F.coalesce(p["base_html"], s["now"], p["first_html"]), p["sections"])
        # one struct, so that the text is worked out once
        return F.transform(F.array(now), lambda x: F.struct(x.alias("now"), F.concat(s["out"], F.array(F.struct(
            p["stretch"].alias("stretch"), x.alias("html"), p["last"]["title"].alias("post_title")))).alias("out")))[0]

    states = F.aggregate("_parts", start, step, lambda s: s["out"])
    rows = rows.withColumn("states", states)
    return rows.select("slug", "existing", "_old_title", "states", F.get("_parts", F.lit(0))["first_request"].alias("first_request"),
                       *[F.element_at("_parts", -1)["last"][f].alias(f) for f in fields])


def meta_states(ops: DataFrame, cuts: DataFrame, requests: DataFrame, postmeta: DataFrame, pages: DataFrame) -> DataFrame:
    """``slug, version, seo_meta``: the non-empty values of SNAPSHOT_META_KEYS of a page just before each kept save.

    ``pages`` has slug and post_id. A page has at most as many keys and stretches as the two limits say, so its row is bounded.
    """
    where = _stretched(requests.select("slug", "request_id", "requested_at"), cuts).select("slug", "request_id", "stretch")
    mine = ops.filter(F.col("meta_key").isin(*SNAPSHOT_META_KEYS)).join(where, "request_id")
    parts = composed(mine, ["slug", "stretch", "meta_key"])
    parts = parts.groupBy("slug", "meta_key").agg(F.array_sort(F.collect_list(F.struct("stretch", "_set", "_added"))).alias("_parts"))
    old = load_postmeta(postmeta, SNAPSHOT_META_KEYS).join(pages.select("slug", "post_id"), "post_id").select("slug", "meta_key", F.col("meta_value").alias("_old"))
    keyed = parts.join(old, ["slug", "meta_key"], "full").groupBy("slug").agg(F.collect_list(F.struct("meta_key", "_old", "_parts")).alias("_keys"))
    kept = cuts.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("cut", "version"))).alias("_kept"))
    rows = kept.join(keyed, "slug", "left").select("slug", "_keys", F.posexplode("_kept").alias("_i", "_v"))
    value = lambda k: F.aggregate(F.filter(F.coalesce(k["_parts"], F.array()), lambda p: p["stretch"] <= F.col("_i")), k["_old"],
                                  lambda v, p: _applied(v, p["_set"], p["_added"]))
    entries = F.transform(F.coalesce("_keys", F.array()), lambda k: F.struct(k["meta_key"].alias("key"), value(k).alias("value")))
    entries = F.array_sort(F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != "")))
    return rows.select("slug", F.col("_v.version").alias("version"), F.map_from_entries(entries).alias("seo_meta"))


def saved_versions(pages: DataFrame, cuts: DataFrame) -> DataFrame:
    """``slug, page_id, version, content, post_title`` of every kept save: the page as it stood before it.

    ``pages`` are ``replayed_pages``. Before the batch that is the stored html; later the merged html in its wrapper.
    """
    kept = cuts.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("cut", "version"))).alias("_kept"))
    rows = pages.join(kept, "slug").select("slug", page_id().alias("page_id"), "existing", "_old_title", "states", F.posexplode("_kept").alias("_i", "_v"))
    before = F.element_at(F.concat(F.array(F.lit(None)), F.filter("states", lambda s: s["stretch"] <= F.col("_i"))), -1)
    return rows.withColumn("_s", before).select(
        "slug", "page_id", F.col("_v.version").alias("version"), F.when(F.col("_s").isNull(), F.col("existing")).otherwise(wrap_content(F.col("_s.html"))).alias("content"),
        F.when(F.col("_s").isNull(), F.col("_old_title")).otherwise(F.col("_s.post_title")).alias("post_title"))


def page_id() -> Column:
    """A page's id: that of the post with its slug, else one made of the request that creates it."""
    return F.coalesce("post_id", F.lit(NEW_ID) + F.col("first_request"))


def version_ledger(seconds: DataFrame, pages: DataFrame, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the batch's saves do to the version rows: (``page_id, version, action``, count rows ``page_id, meta_key, meta_value``).

    Cleanup runs after every save and keeps the newest KEPT_VERSIONS, so at the end the newest of stored and new versions
    stay: ``saved`` (new or written anew), ``kept`` or ``deleted`` (stored before). New ones that later saves push
    out were written and deleted within the batch: ``dropped``. Only pages that save are listed. The count grows by one with every save, those of one second too.
    """
    ids = pages.select("slug", page_id().alias("page_id"))
    new = seconds.join(ids, "slug").select("page_id", "version", "n_saves")
    touched = new.select("page_id").distinct()
    both = new.join(versions.select("page_id", "version", F.lit(True).alias("_stored")).join(touched, "page_id", "left_semi"), ["page_id", "version"], "full")
    top = newest(both, "page_id", KEPT_VERSIONS).select("page_id", "version", F.lit(True).alias("_top"))
    rows = both.join(top, ["page_id", "version"], "left")
    fresh, stays = F.col("n_saves").isNotNull(), F.col("_top").isNotNull()
    action = F.when(fresh & stays, "saved").when(stays, "kept").when(F.col("_stored").isNotNull(), "deleted").otherwise("dropped")
    old = versions.groupBy("page_id").agg(F.count(F.lit(1)).alias("_old"))  # without a count row of its own, a page has counted the versions stored
    counts = new.groupBy("page_id").agg(F.sum("n_saves").alias("_n")).join(old, "page_id", "left")
    counts = counts.select("page_id", F.lit(VERSION_COUNT_KEY).alias("meta_key"), (F.col("_n") + F.coalesce("_old", F.lit(0))).cast("string").alias("meta_value"))
    return rows.select("page_id", "version", action.alias("action")), counts


# Fields of an SEO update that go through the meta rules; source that it records.
SEO_FIELDS = ("meta_title", "meta_description", "focus_keyword", "canonical", "og_title", "og_description", "og_image")
UPDATE_SOURCE = "manager_api"


def seo_update_writes(requests: DataFrame, posts: DataFrame, postmeta: DataFrame, active: DataFrame, trees: DataFrame) -> dict[str, DataFrame]:
    """``meta``, ``posts`` and ``trees`` after a batch of partial SEO updates (request_id, post_id, requested_at, SEO_FIELDS, page_title, schema).

    A null field is not given and leaves what is there; an empty one is given and, by the rules of
    ``seo_ops``, writes nothing either. Per post the last title and the last schema given count: the schema's block replaces
    the one in the content or is appended; the title becomes that of the post and of the first heading of its tree. Requests for unknown posts
    write nothing; posts that none names are not returned. meta: post_id, meta_key, meta_value; posts: post_id,
    post_title, post_content; trees: page_id, action, target_path, tree_json.
    """
    from pagelens.operators.publish import SCHEMA_SECTION_RE, replace_all_literal, schema_block
    from pagelens.operators.tree import tree_set_h1

    kind = dict(posts.dtypes)["id"]
    known = requests.join(posts.select(F.col("id").alias("post_id")), "post_id", "left_semi").withColumn("post_id", F.col("post_id").cast(kind))
    text = {c: F.lit(None).cast("string") for c in ("twitter_title", "twitter_description")}
    given = F.coalesce(*[F.col(f) for f in SEO_FIELDS]).isNotNull()
    ops = seo_ops(known.filter(given).withColumns(text | {"secondary_keywords": F.array().cast("array<string>")}), active)
    always, some = F.lit(True), F.col("schema").isNotNull()
    data = F.try_parse_json("schema")
    listed = F.when(data.isNotNull(), F.concat(F.lit('{"main":'), F.col("schema"), F.lit("}"))).otherwise(F.to_json(F.struct(F.col("schema").alias("main"))))
    own = _ops(known, [(some, F.lit("_echo5_structured_data"), "set", F.col("schema")), (some, F.lit("_echo5_schemas"), "set", listed),
                       (always, F.lit("_echo5_last_seo_update"), "set", stamp(F.col("requested_at"))), (always, F.lit("_echo5_seo_update_source"), "set", F.lit(UPDATE_SOURCE))])
    at = F.struct("requested_at", "request_id")
    last = known.groupBy("post_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in ("page_title", "schema")])
    old = posts.select(F.col("id").alias("post_id"), "post_title", "post_content")
    whole = F.map_from_arrays(F.array(F.lit("main")), F.array("schema"))
    parts = F.from_json("schema", "map<string,string>")
    single = parts.isNull() | F.exists(F.map_keys(F.coalesce(parts, F.create_map().cast("map<string,string>"))), lambda k: k.isin("@context", "@type", "@graph"))
    block = schema_block(F.when(single, whole).otherwise(parts), unicode=True)
    content = F.col("post_content")
    has = F.size(F.split(content, SCHEMA_SECTION_RE)) > 1
    written = F.when(F.col("schema").isNull(), content).when(has, replace_all_literal(content, F.lit(SCHEMA_SECTION_RE), F.col("_block"))).otherwise(F.concat(content, F.lit("\n"), F.col("_block")))
    changed = last.withColumn("_block", F.when(F.col("schema").isNotNull(), block)).join(old, "post_id").select("post_id", F.coalesce("page_title", "post_title").alias("post_title"), written.alias("post_content"))
    titles = last.filter("page_title IS NOT NULL").select(F.col("post_id").alias("page_id"), F.col("page_title").alias("title"))
    return {"meta": apply_ops(ops.unionByName(own.withColumn("step", F.col("step") + 100)), postmeta), "posts": changed, "trees": tree_set_h1(trees, titles)}
