"""The filter audit against plain Python: odd rows, repeated and null ids, labels that repeat, clashing columns, empty tables."""

import itertools
import random
import re

from pagelens.llm import filter_audit
from test_operators import corpus, frame


def mask(text, least, doc):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    rank = (doc is None, doc)
    return {f for f, fails in zip("ABCDE", (
        len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search("[#$%&*|]", text)),
        rank[0] != least[text][0] or (not rank[0] and doc > least[text][1]))) if fails}


def audited(docs, labels):
    least = {}
    for doc, text, _ in docs:
        rank = (doc is None, doc or 0)
        least[text or ""] = min(rank, least.get(text or "", rank))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [(doc, lang or "", mask(text, least, doc)) for doc, text, lang in docs]
    for part in {r[1] for r in rows}:
        mine = [(d, m) for d, p, m in rows if p == part]
        out, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            for i, f in enumerate(order):
                left = [(d, m) for d, m in mine if not m & set(order[:i])]
                lost = [d for d, m in left if f in m]
                shapley[f] += len(lost)
                out.append((part, order, i + 1, len(left) - len(lost), len(lost), sum(f in m for _, m in mine) - len(lost), sum(m == {f} for _, m in mine),
                            sum(d in good for d in lost), sum(d in toxic for d in lost)))
        yield from ((*o, shapley[o[1][o[2] - 1]]) for o in out)


def test_audit(spark):
    draw = random.Random(12)
    texts = [" ".join(draw.choices(["Aa", "BB", "c", "d$", "e", "f\x0bg", "h i"] + [f"w{i}" for i in range(k)], k=draw.choice([0, 5, 99, 100, 101, 300]))) for k in (0, 60, 900) for _ in range(25)]
    texts += [" ".join(f"w{i}" for i in range(100)), "x" * 9 + "A", "x" * 8 + "AA", "é" * 9 + "A", "w " * 40_000 + "END", "|", None, "", " \n"]
    rows = [(i, t, draw.choice(["en", "de", "", None, "x y"])) for i, t in enumerate(texts + draw.choices(texts, k=60))]
    rows += [(d, t, "en") for d, t in corpus(4)] + rows[:5] + rows[:2] + [(None, texts[0], "en"), (None, "only here", "de"), (None, "only here", "de")]
    labels = [(d, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for d, _, _ in rows[:120]] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs.selectExpr("*", "1 AS part", "2 AS _id", "3 AS _mask", "'x' AS quality", "5 AS _n")
    got = filter_audit.audit(docs, marks)
    assert sorted(map(tuple, got.collect())) == sorted(audited(rows, labels))
    bare = filter_audit.audit(docs, marks.limit(0))
    assert bare.agg({"good_lost": "max", "toxic_lost": "max"}).first()[:] == (0, 0) and bare.count() == got.count()
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
