"""Brute-force checks for the order-dependent folds that have no SQL oracle.

The expected values come from a plain-Python transcription of the rules
(merge by RGB similarity, greedy slot assignment) applied to the same inputs
(kit globals and top colours) that Spark computed, at sf0.01.
"""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from pagelens.operators import brand as BR
from pagelens.operators.access import rate_limit
from pagelens.sources.tables import Tables


def _rgb(h):
    h = (h or "").lstrip("#")
    if len(h) != 6:
        return None
    def ch(s):
        d = "".join(c for c in s if c in "0123456789abcdefABCDEF")
        return int(d, 16) if d else 0
    return ch(h[0:2]), ch(h[2:4]), ch(h[4:6])


def _similar(a, b):
    ra, rb = _rgb(a), _rgb(b)
    if not ra or not rb:
        return False
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(ra, rb))) < 30


def _merge(globals_, extracted):
    out = list(globals_)
    for c in extracted:
        if not any(_similar(c["value"], o["value"]) for o in out):
            out.append(c)
    return out


def _slots(colors):
    order = sorted(range(len(colors)), key=lambda i: (-colors[i]["frequency"], i))
    s = {k: None for k in BR.COLOR_SLOTS}
    extra = []
    for i in order:
        c = colors[i]
        rgb = _rgb(c["value"])
        if rgb is None:
            continue
        lum = (0.299 * rgb[0] + 0.587 * rgb[1] + 0.114 * rgb[2]) / 255
        name = (c["name"] or "").lower()
        if c["source"] == "global":
            for k in ("primary", "secondary", "accent", "text"):
                if k in name and s[k] is None:
                    s[k] = c
                    break
            else:
                extra.append(c)
            continue
        if "button" in name:
            if s["buttonBg"] is None:
                s["buttonBg"] = c
            elif s["buttonText"] is None:
                s["buttonText"] = c
        elif "heading" in name and s["heading"] is None:
            s["heading"] = c
        elif "background" in name and lum > 0.7 and s["background"] is None:
            s["background"] = c
        elif lum < 0.3 and s["text"] is None:
            s["text"] = c
        elif s["primary"] is None and 0.2 < lum < 0.8:
            s["primary"] = c
        elif s["secondary"] is None and 0.2 < lum < 0.8:
            s["secondary"] = c
        else:
            extra.append(c)
    rows = {(k, 0, v["value"]) for k, v in s.items() if v is not None}
    rows |= {("additional", i, v["value"]) for i, v in enumerate(extra[:5])}
    return rows


def test_color_merge_and_slots_match_brute_force(spark):
    t = Tables(spark, MEDIUM)
    st = BR.analyzed_settings(t.posts, t.builder_trees)
    kit = BR.kit_tokens(t.kit_settings)
    top = BR.top_k(BR.color_frequency(st), BR.TOP_COLORS)
    merged = BR.color_merge(kit, top)

    kit_rows = kit.filter(F.col("section") == "color").orderBy("site_id", "pos").collect()
    top_rows = (top.withColumn("hex", F.expr("upper(color)"))
                .join(merged.select("site_id", F.explode("colors").alias("c"))
                      .filter(F.col("c.source") == "extracted").select("site_id", F.col("c.value").alias("hex"),
                                                                        F.col("c.name").alias("name")),
                      ["site_id", "hex"], "left")
                .orderBy("site_id", "rank").collect())
    sites = {r.site_id for r in top_rows} | {r.site_id for r in kit_rows}
    spark_merge = {r.site_id: [c.value for c in r.colors] for r in merged.collect()}
    spark_slots = {}
    for r in BR.color_slots(merged).collect():
        spark_slots.setdefault(r.site_id, set()).add((r.slot, r.ord, r.value))
    for site in sites:
        g = [{"value": r.value, "name": r.name, "source": "global", "frequency": 999} for r in kit_rows
             if r.site_id == site]
        e = []
        for r in top_rows:
            if r.site_id != site or _rgb(r.color) is None and not r.color.startswith("#"):
                continue
            if len(r.color) != 7:  # 7-digit results of rgb(>255) drop out at normalisation
                continue
            e.append({"value": r.color, "name": r.name, "source": "extracted", "frequency": r["count"]})
        m = _merge(g, e)
        assert spark_merge.get(site, []) == [c["value"] for c in m], site
        assert spark_slots.get(site, set()) == _slots(m), site


def rate_limit_by_hand(rows, limit, window):
    """event_id -> accepted, request by request."""
    out, state = {}, {}
    for ip, t, event in sorted(rows):
        count, last = state.get(ip, (0, None))
        if last is None or t - last > window * 1_000_000:
            count, last, out[event] = 1, t, True
        elif count < limit:
            count, last, out[event] = count + 1, t, True
        else:
            out[event] = False
        state[ip] = (count, last)
    return out


@pytest.mark.parametrize("limit,window,block", [(3, 60, 40), (1, 60, 1), (25, 7, 5), (200, 30, 60), (3, 600, 1), (2, 60, 10**9)])
def test_rate_limit_inside_a_never_idle_address(spark, limit, window, block):
    draw = random.Random(limit * window)
    rows, event = [], 0
    for ip, n, gap in (("busy", 900, window / 2), ("flood", 600, 0.2), ("steady", 300, window), ("idle", 60, 3 * window), ("mixed", 400, 1.5 * window)):
        t = 1_700_000_000_000_000 + draw.randrange(10**9)
        for _ in range(n):
            event += 1
            t += draw.choice([0, 1, int(draw.random() * gap * 1_000_000), int(gap * 1_000_000)])
            rows.append((ip, t, event))
    df = spark.createDataFrame(rows, "ip string, t long, event_id long").withColumn("ts", F.timestamp_micros("t")).repartition(4)
    got = {r.event_id: r.accepted for r in rate_limit(df, limit, window, block_events=block).collect()}
    assert got == rate_limit_by_hand(rows, limit, window)
    assert len(set(got.values())) == 2
    assert rate_limit(df.limit(0), limit, window, block_events=block).count() == 0
