"""Batches: several tables in one commit, operations in order, versions and rollbacks, against plain Python on small tables."""

import random

import pytest
from pagelens.operators import replay as R
from pagelens.operators import rollbacks as RB
from pagelens.session import checkpoint_dir
from pagelens.sources.sinks import commit_tables, committed
from pyspark.sql import functions as F


@pytest.fixture
def root(spark, tmp_path):
    checkpoint_dir(spark)
    return str(tmp_path)


def tables(spark, n):
    return {"a": spark.range(n).select(F.col("id"), F.lit(n).alias("n")), "b": spark.range(2 * n)}


def test_a_killed_and_repeated_batch_leaves_one_copy(spark, root):
    def dies(folder):
        tables(spark, 7)["a"].write.parquet(f"{folder}/a")
        raise RuntimeError("killed")

    commit_tables(spark, root, "one", lambda _: tables(spark, 3))
    with pytest.raises(RuntimeError):
        commit_tables(spark, root, "two", dies)
    assert committed(spark, root, "a").count() == 3
    commit_tables(spark, root, "two", lambda _: tables(spark, 5))
    with pytest.raises(RuntimeError):
        commit_tables(spark, root, "one", dies)  # the earlier commit stays valid
    assert (committed(spark, root, "a").count(), committed(spark, root, "b").count()) == (8, 16)
    commit_tables(spark, root, "two", lambda _: tables(spark, 4))  # replaces its own
    assert sorted((r.batch, r.n) for r in committed(spark, root, "a").select("batch", "n").distinct().collect()) == [("one", 3), ("two", 4)]


def test_operations_in_order(spark):
    draw = random.Random(3)
    ops = [(p, q, f"2024-01-01 00:00:{q % 60:02}", s, k, draw.choice(["set", "append", "append"]), draw.choice(["x", "y", "z", "0", ""]))
           for p in (1, 2, 3) for k in (R.APPENDED_KEY, "other") for q in range(draw.randint(1, 9)) for s in range(2)]
    meta = [(1, 1, R.APPENDED_KEY, "old"), (2, 2, R.APPENDED_KEY, "0")]
    expected = {}
    for p, _, _, _, k, op, v in sorted(ops, key=lambda o: (o[0], o[4], o[2], o[1], o[3])):
        now = expected.get((p, k), next((m[3] for m in meta if m[1:3] == (p, k)), None))
        expected[p, k] = v if op == "set" or now in (None, "", "0") else f"{now},{v}"
    frame = spark.createDataFrame(draw.sample(ops, len(ops)), "post_id long, request_id long, requested_at string, step int, meta_key string, op string, value string")
    got = R.apply_ops(frame, spark.createDataFrame(meta, "meta_id long, post_id long, meta_key string, meta_value string"))
    assert {(r.post_id, r.meta_key): r.meta_value for r in got.collect()} == expected


def test_keywords_are_appended_for_rankmath_only(spark):
    rows = [(1, 5, "2024-01-01 00:00:01", "a", ["b"]), (2, 5, "2024-01-01 00:00:02", None, ["c", "d"]), (3, 6, "2024-01-01 00:00:01", None, ["e"]), (4, 7, "2024-01-01 00:00:01", "k", ["f"])]
    requests = spark.createDataFrame(rows, "request_id long, post_id long, requested_at string, focus_keyword string, secondary_keywords array<string>").withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    requests = requests.withColumns({c: F.lit(None).cast("string") for c in ("meta_title", "meta_description", "canonical", "og_title", "og_description", "og_image", "twitter_title", "twitter_description")})
    active = spark.createDataFrame([(5, "rankmath"), (6, "rankmath"), (7, "yoast")], "id long, seo_plugin string")
    meta = spark.createDataFrame([(1, 6, R.APPENDED_KEY, "had")], "meta_id long, post_id long, meta_key string, meta_value string")
    got = {(r.post_id, r.meta_key): r.meta_value for r in R.apply_ops(R.seo_ops(requests, active), meta).collect()}
    assert got[5, R.APPENDED_KEY] == "a,b,c,d" and got[6, R.APPENDED_KEY] == "had,e" and (7, R.APPENDED_KEY) not in got
    assert got[5, "_echo5_secondary_keywords"] == '["c","d"]' and got[7, "_yoast_wpseo_focuskw"] == "k" and got[5, "_echo5_seo_updated"] == "2024-01-01 00:00:02"


def test_versions_of_a_busy_page(spark):
    rows = [(i, "busy", f"2024-01-01 00:{i // 2:02}:00", None, f"<p>{i}</p>", "full", f"t{i}") for i in range(30)] + [(99, "old", "2024-01-01 01:00:00", 7, "<p>n</p>", "full", "n")]
    requests = spark.createDataFrame(rows, "request_id long, slug string, requested_at string, post_id long, html string, update_mode string, title string").withColumn("requested_at", F.col("requested_at").cast("timestamp"))
    posts = spark.createDataFrame([(7, "stored", "title")], "id long, post_content string, post_title string")
    seconds = R.saves(requests)
    cuts = R.newest(seconds, "slug", R.KEPT_VERSIONS)
    pages = R.replayed_pages(requests, posts, cuts)
    busy = R.NEW_ID  # the first request's id is 0
    saved = {(r.page_id, r.version - 1704067200): (r.content, r.post_title) for r in R.saved_versions(pages, cuts).collect()}
    assert {k[1] for k in saved if k[0] == busy} == {60 * m for m in range(6, 15)}
    assert all(f"<p>{m // 30}</p>" in saved[busy, m][0] and saved[busy, m][1] == f"t{m // 30}" for m in range(360, 900, 60))  # before the later of two saves in a second
    assert saved[7, 3600] == ("stored", "title")
    versions = spark.createDataFrame([(7, 5), (8, 1)] + [(busy, v) for v in (3, 1704067200 + 5000)], "page_id long, version long")
    ledger, counts = R.version_ledger(seconds, pages, versions)
    acts = {(r.page_id, r.version): r.action for r in ledger.collect()}
    assert acts[7, 5] == "kept" and acts[busy, 3] == "deleted" and acts[busy, 1704067200 + 5000] == "kept" and acts[busy, 1704067200 + 360] == "dropped" and (8, 1) not in acts
    assert {r.page_id: r.meta_value for r in counts.collect()} == {7: "2", busy: "31"}


def test_rollbacks_take_versions_saved_before_them(spark):
    checkpoint_dir(spark)
    stored = [(1, 10, '{"content":"A","seo_meta":{"_yoast_wpseo_title":"ta"},"post_title":"TA"}'), (1, 11, "plain {text"), (1, 12, "0"), (1, 13, '{"no":"content"}'), (3, 10, "x")]
    posts = [(1, "page", "now", "T"), (2, "post", "two", "T2"), (3, "attachment", "three", "T3")]
    meta = [(1, 1, "_yoast_wpseo_title", "t0"), (2, 1, "_yoast_wpseo_metadesc", "d0")]
    asked = [(1, 1, 10, 100), (2, 1, 11, 101), (3, 1, 100, 102), (4, 1, 101, 103), (5, 1, 12, 104), (6, 1, 555, 105), (7, 2, 10, 100), (8, 3, 10, 100), (9, 4, 10, 100), (10, 1, 13, 106)]
    out = RB.rollback_batch(spark.createDataFrame(asked, "request_id long, page_id long, version long, s long").withColumn("requested_at", F.timestamp_seconds("s")),
                            spark.createDataFrame(posts, "id long, post_type string, post_content string, post_title string"),
                            spark.createDataFrame(meta, "meta_id long, post_id long, meta_key string, meta_value string"),
                            spark.createDataFrame(stored, "page_id long, version long, meta_value string"))
    log = {r.request_id: (r.status, r.seo_meta_restored) for r in out["log"].collect()}
    assert log == {1: ("rolled_back", True), 2: ("rolled_back", False), 3: ("rolled_back", True), 4: ("rolled_back", True), 5: ("version_not_found", False),
                   6: ("version_not_found", False), 7: ("version_not_found", False), 8: ("not_found", False), 9: ("not_found", False), 10: ("rolled_back", False)}
    # 3 brings back the page as it was before; 4 what stood before the second rollback; 10 a text without content is the content itself
    assert [tuple(r) for r in out["posts"].collect()] == [(1, '{"no":"content"}', "TA")]
    assert {r.meta_key: r.meta_value for r in out["meta"].collect()} == {"_yoast_wpseo_title": "ta", "_yoast_wpseo_metadesc": "d0"}
    assert {r.version: (r.content, r.post_title, r.n_saves) for r in out["versions"].collect()} == {
        100: ("now", "T", 5), 101: ("A", "TA", 5), 102: ("plain {text", "TA", 5), 103: ("now", "T", 5), 106: ("A", "TA", 5)}
    empty = spark.createDataFrame([], "request_id long, page_id long, version long, requested_at timestamp")
    none = RB.rollback_batch(empty, spark.createDataFrame(posts, "id long, post_type string, post_content string, post_title string"),
                             spark.createDataFrame(meta, "meta_id long, post_id long, meta_key string, meta_value string"), spark.createDataFrame(stored, "page_id long, version long, meta_value string"))
    assert [df.count() for df in none.values()] == [0, 0, 0, 0]
