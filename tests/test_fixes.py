"""Cases that the shared fixtures do not reach: nested secrets, repeated meta writes, address rules, references in text."""

import json

from pagelens.operators import access as A
from pagelens.operators import logs as L
from pagelens.operators import publish as P
from pagelens.operators.blocks import decode_entities
from pagelens.operators.seo import distinct_plugins
from pyspark.sql import functions as F


def test_append_log_redacts_nested_values(spark):
    data = json.dumps({"request": {"authorization": {"bearer": "SECRET1"}, "a": [{"Token": ["SECRET2"]}], "ok": "x"},
                       "response": {"password": "SECRET3"}, "slug": "s"})
    calls = spark.createDataFrame([("publish_start", data, None, "10.0.0.9", "2024-01-01")], "action string, data string, status string, user_ip string, created_at string")
    row = L.append_log(calls).first()
    assert "SECRET" not in str(row) and row.user_ip == "10.0.0.9" and json.loads(row.request_data)["ok"] == "x"


def test_each_meta_key_is_written_once(spark):
    requests = spark.createDataFrame([(1, 7, "T", "D", "K", "C", "OT", "OD")], "request_id long, post_id long, meta_title string, meta_description string, "
                                     "focus_keyword string, canonical string, og_title string, og_description string")
    for plugin in ("yoast", "rankmath", "aioseo", "seopress", "generic"):
        active = spark.createDataFrame([(7, plugin)], "id long, seo_plugin string")
        keys = [r.meta_key for r in P.save_meta_map(requests, active).collect()]
        assert len(keys) == len(set(keys)), plugin
        meta = spark.createDataFrame([(1, 7, keys[0], "old"), (2, 8, "other", "x")], "meta_id long, post_id long, meta_key string, meta_value string")
        out = P.upsert_meta(meta, P.save_meta_map(requests, active).unionByName(P.save_meta_map(requests, active)))
        assert out.count() == len(keys) + 1


def test_whitelist_by_address(spark):
    requests = spark.createDataFrame([(1, "10.0.0.5"), (2, "10.0.1.5"), (3, "2001:db8::1"), (4, None), (5, "10.0.0.5")], "event_id long, ip string").repartition(3)
    entries = spark.createDataFrame([("10.0.0.0/24",), ("2001:db8::1",), (" ",)], "entry string")
    allowed = lambda e: {r.event_id: r.allowed for r in A.ip_whitelist(requests, e).collect()}
    assert allowed(entries) == {1: True, 2: False, 3: True, 4: False, 5: True}
    assert set(allowed(entries.limit(0)).values()) == {True}


def test_character_references(spark):
    df = spark.createDataFrame([("Caf&eacute; na&iuml;ve &euro;5 &raquo; &amp;lt; &#233;&#xE9; &nosuch; a&b &amp",), ("plain",), (None,)], "t string")
    assert [r[0] for r in df.select(decode_entities(F.col("t"))).collect()] == ["Café naïve €5 » &lt; éé &nosuch; a&b &amp", "plain", None]


def test_network_plugins_by_network(spark):
    sites = spark.createDataFrame([(1, 10, "a"), (2, 11, "b")], "site_id long, network_id long, path string")
    network = spark.createDataFrame([(10, "n"), (10, "a"), (12, "z")], "network_id long, path string")
    assert sorted(tuple(r) for r in distinct_plugins(sites, network).collect()) == [(1, "a"), (1, "n"), (2, "b")]
