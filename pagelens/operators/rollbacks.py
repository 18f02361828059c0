"""Rollbacks of a batch in sequence: each first saves the page as it is, then restores a version, perhaps one saved by an earlier rollback.

Whatever a rollback restores is, in the end, the page as it was before the batch or a stored
version; so the sequence is resolved on version numbers alone. A page's stored version numbers and
its requests go to one task in order of time and are folded as a stream: the state is the page's present
sources (of text, title and meta) and its versions, of which cleanup leaves KEPT_VERSIONS after every save. No
text takes part; texts are joined once, to what the fold says. A page with very many rollbacks is one task, with bounded state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions.common import falsy
from pagelens.operators.replay import KEPT_VERSIONS
from pagelens.operators.seo import load_postmeta
from pagelens.operators.versions import SNAPSHOT_META_KEYS

_SNAPSHOT = "content string, seo_meta map<string,string>, post_title string"
#: The page as it was before the batch.
BEFORE = "before"


def parsed_versions(stored: DataFrame) -> DataFrame:
    """``page_id, version, content, post_title, seo_meta`` of stored version texts (``page_id, version, meta_value``).

    A JSON object with content is a snapshot; any other text is the content itself, of the
    time before titles and meta were saved. Empty texts ('0' too) are no versions.
    """
    new = F.from_json("meta_value", _SNAPSHOT)
    rows = stored.filter(~falsy(F.col("meta_value"))).withColumn("_s", F.when(F.ltrim("meta_value").startswith("{"), new))
    fresh = F.col("_s.content").isNotNull()
    return rows.select("page_id", "version", F.when(fresh, F.col("_s.content")).otherwise(F.col("meta_value")).alias("content"),
                       F.when(fresh, F.col("_s.post_title")).alias("post_title"), F.when(fresh, F.col("_s.seo_meta")).alias("seo_meta"))


class Page:
    """A page during the batch: where its text, title and meta come from, and the versions that it has."""

    def __init__(self, exists: bool, has_meta: bool):
        self.exists, self.base = exists, [BEFORE] if has_meta else []
        self.text = self.title = BEFORE
        self.meta: list[str] = []  # sources whose values lie over one another, the last on top
        self.versions: dict[int, tuple[str, str | None, list[str]]] = {}

    def store(self, version: int, has_title: bool, has_meta: bool) -> None:
        name = str(version)
        self.versions[version] = (name, name if has_title else None, [name] if has_meta else [])

    def restore(self, version: int, second: int) -> tuple[str, bool]:
        """Status, and whether meta was restored."""
        if not self.exists:
            return "not_found", False
        if version not in self.versions:
            return "version_not_found", False
        text, title, meta = self.versions[version]
        self.versions[second] = (self.text, self.title, self.base + self.meta)
        for old in sorted(self.versions)[:-KEPT_VERSIONS]:
            del self.versions[old]
        self.text, self.title = text, title or self.title
        self.meta = [m for m in self.meta if m not in meta] + meta
        return "rolled_back", bool(meta)


_EVENT = "page_id long, kind string, version long, request_id long, status string, restored boolean, text string, title string, meta array<string>, n_saves long"


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of page, stored versions before requests: a ``log`` row per request, ``page`` and ``saved`` rows of pages that changed."""
    page, key, saves, mine = None, None, 0, set()

    def closing():
        if page is not None and saves:
            yield (key, "page", None, None, None, None, page.text, page.title, page.meta, saves)
            for v, (text, title, meta) in page.versions.items():
                if v in mine:
                    yield (key, "saved", v, None, None, None, text, title, meta, None)

    columns = [c.split()[0] for c in _EVENT.split(", ")]
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            if r.page_id != key:
                out += closing()
                key, page, saves, mine = r.page_id, Page(r.exists, r.has_meta), 0, set()
            if r.stored:
                page.store(r.version, r.titled, r.with_meta)
                continue
            status, restored = page.restore(r.version, r.second)
            if status == "rolled_back":
                saves += 1
                mine.add(r.second)
                mine &= page.versions.keys()
            out.append((r.page_id, "log", r.version, r.request_id, status, restored, None, None, None, None))
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"version": "Int64", "request_id": "Int64", "n_saves": "Int64"})
    if last := list(closing()):
        yield pd.DataFrame(last, columns=columns).astype({"version": "Int64", "request_id": "Int64", "n_saves": "Int64"})


def rollback_batch(requests: DataFrame, posts: DataFrame, postmeta: DataFrame, stored: DataFrame) -> dict[str, DataFrame]:
    """``log``, ``posts``, ``meta`` and ``versions`` after the rollbacks of ``requests`` (request_id, page_id, version, requested_at), in order.

    log: request_id, page_id, version, status (``rolled_back``, ``version_not_found``, ``not_found`` where there is no page or post)
    and seo_meta_restored. posts: page_id, content, post_title of pages that changed. meta: page_id, meta_key, meta_value of the
    values that were restored (empty ones are deleted), as they stand in the end. versions: page_id, version, content, post_title of the versions
    saved on the way that cleanup left, and n_saves by which the page's count grows. A version saved twice in a second holds the later save.
    """
    versions = parsed_versions(stored)
    asked = requests.select("page_id").distinct()
    pages = posts.filter(F.col("post_type").isin("page", "post")).select(F.col("id").cast("long").alias("page_id"), F.lit(True).alias("_page"))
    old = load_postmeta(postmeta, SNAPSHOT_META_KEYS).filter("meta_value IS NOT NULL AND meta_value <> ''").select(F.col("post_id").cast("long").alias("page_id"), "meta_key", "meta_value")
    facts = asked.join(pages, "page_id", "left").join(old.select("page_id").distinct().withColumn("_meta", F.lit(True)), "page_id", "left").select(
        "page_id", F.coalesce("_page", F.lit(False)).alias("exists"), F.coalesce("_meta", F.lit(False)).alias("has_meta"))
    none = F.lit(None).cast("timestamp")
    has = F.size(F.coalesce("seo_meta", F.create_map().cast("map<string,string>"))) > 0
    have = versions.join(asked, "page_id", "left_semi").select("page_id", "version", F.lit(True).alias("stored"), F.lit(0).cast("long").alias("request_id"), none.alias("_at"),
                                                               F.lit(0).cast("long").alias("second"), F.col("post_title").isNotNull().alias("titled"), has.alias("with_meta"))
    want = requests.select("page_id", "version", F.lit(False).alias("stored"), "request_id", F.col("requested_at").cast("timestamp").alias("_at"),
                           F.unix_timestamp(F.col("requested_at").cast("timestamp")).alias("second"), F.lit(False).alias("titled"), F.lit(False).alias("with_meta"))
    rows = have.unionByName(want).join(facts, "page_id")
    rows = rows.repartition("page_id").sortWithinPartitions("page_id", F.col("stored").desc(), "_at", "request_id").drop("_at")
    events = rows.mapInPandas(_folded, _EVENT).checkpoint()

    text = versions.select("page_id", F.col("version").cast("string").alias("_from"), "content", "post_title", "seo_meta")
    before = posts.join(asked.withColumnRenamed("page_id", "id"), "id", "left_semi").select(
        F.col("id").cast("long").alias("page_id"), F.lit(BEFORE).alias("_from"), F.col("post_content").alias("content"), "post_title", F.lit(None).cast("map<string,string>").alias("seo_meta"))
    sources = text.unionByName(before)

    def filled(kind: str) -> DataFrame:
        some = events.filter(F.col("kind") == kind)
        body, title = sources.select("page_id", F.col("_from").alias("text"), "content"), sources.select("page_id", F.col("_from").alias("title"), "post_title")
        return some.join(body, ["page_id", "text"]).join(title, ["page_id", "title"])

    # the values of the sources over one another: the last that has a key gives it
    layers = events.filter("kind = 'page'").select("page_id", F.posexplode("meta").alias("_on", "_from"))
    given = sources.filter("seo_meta IS NOT NULL").select("page_id", "_from", F.explode("seo_meta").alias("meta_key", "meta_value"))
    given = given.unionByName(old.select("page_id", F.lit(BEFORE).alias("_from"), "meta_key", "meta_value"))
    meta = layers.join(given, ["page_id", "_from"]).groupBy("page_id", "meta_key").agg(F.max_by("meta_value", "_on").alias("meta_value"))
    return {
        "log": events.filter("kind = 'log'").select("request_id", "page_id", "version", "status", F.col("restored").alias("seo_meta_restored")),
        "posts": filled("page").select("page_id", "content", "post_title"),
        "meta": meta.filter("meta_value IS NOT NULL AND meta_value <> ''"),
        "versions": filled("saved").join(events.filter("kind = 'page'").select("page_id", F.col("n_saves").alias("_n")), "page_id").select(
            "page_id", "version", "content", "post_title", F.col("_n").alias("n_saves")),
    }
