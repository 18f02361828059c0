"""Importance resampling against plain Python: CRCs, pieces of any size, ties, repeated and null ids, clashing columns, empty tables."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pagelens.llm import resampling
from test_operators import corpus, frame, words

BENCH = [(1, "alpha BETA gamma"), (2, None), (3, ""), (4, "漢字 the of, the of the"), (4, "one two three " * 30)]


def features(text):
    w = words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def buckets(text):
    return [zlib.crc32(f.encode()) % 10_000 for f in features(text)]


def resampled(docs, items, percent=5, least=20):
    s, t = [0] * 10_000, [0] * 10_000
    for rows, count in ((docs, s), (items, t)):
        for _, text in rows:
            for b in buckets(text):
                count[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)]
    out = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets(text))
        out.append((doc, len(buckets(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    long = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = long[:percent * len(long) // 100]
    short = list(out)
    for r in drawn:
        short.remove(r)
    return [(*r[:4], None) for r in short] + [(*r[:4], i) for i, r in enumerate(drawn, 1)]


@pytest.mark.parametrize("piece", [1 << 20, 300, 7])
def test_weights_and_ranks(spark, monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    docs = [(d, t) for d, t in corpus(13, 120) if piece > 7 or len(t or "") < 3000] + [(5, "A-b " * 40)] * 30 + [(6000 + i, "A-b " * 40) for i in range(30)]
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    for percent in (5, 60):
        got = resampling.importance(frame(spark, docs).repartition(4), items, percent=percent)
        assert sorted(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr) == sorted(resampled(docs, BENCH, percent), key=repr)


def test_drawn_rows_keep_their_columns(spark):
    docs = frame(spark, [(i, " ".join(f"w{j % (i + 2)}" for j in range(25))) for i in range(40)] + [(7, None), (None, "x " * 30)]).selectExpr("*", "1 AS id", "2 AS rank", "3 AS `key`", "'n' AS n_features")
    items = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = resampling.resample(docs, items, percent=50)
    assert kept.columns == docs.columns
    ranks = resampling.importance(docs, items, percent=50).filter("rank is not null")
    assert sorted(r[0] for r in ranks.select("rank").collect()) == list(range(1, 21))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r.doc_id for r in ranks.collect())))


def test_empty_tables(spark):
    docs, items = frame(spark, corpus(3, 30)), spark.createDataFrame(BENCH, "item_id long, text string")
    assert resampling.importance(docs.limit(0), items).count() == 0 == resampling.resample(docs.limit(0), items).count()
    assert resampling.importance(docs, items.limit(0)).count() == docs.count()


def test_crcs_of_all_lengths():
    data = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    start, length = np.repeat(np.arange(0, 900, 3), 2), np.tile(np.array([0, 1, 2, 17, 255, 256, 257, 900, 17, 1]), 60)
    got = resampling.crc32s(data, start, length)
    assert got.tolist() == [zlib.crc32(data[s:s + n].tobytes()) for s, n in zip(start, length)]
    assert resampling.crc32s(data, start[:0], length[:0]).tolist() == []
