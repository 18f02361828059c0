"""Importance resampling towards a target distribution, by hashed word n-grams.

Features are runs of one to three words; a feature's bucket is the CRC-32 of its bytes
modulo BUCKETS. CRCs are computed by length-bucketed matrices: the distinct features of a
few hundred KB of text are grouped by equal length into two-dimensional uint8 arrays, all
CRCs of a group are updated column by column, and the buckets are scattered back to every
place of their feature.

Two passes read the texts: one sums bucket counts (a task sends BUCKETS rows at most),
one sums the buckets' gains per document. Texts longer than PIECE are taken in pieces that
carry the last two words along, so memory does not follow a text's length. The draw sorts
(score, id) by ranges over all tasks; places within the ranges and the ranges' counts give the ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import LOWER_BYTE, WORD_BYTE, free, prepare, row_key, table

#: Longest run of words that is a feature, and the number of buckets.
WORDS, BUCKETS = 3, 10_000
#: Bytes of text whose features are worked on at once, so distinct words number under 2**20 and triples fit into 63 bits.
PIECE = 1 << 20
#: Features over so many bytes (a few overlong words) are no matrix but one CRC each.
COLUMNS = 256
#: Fewest words of a document that can be drawn, percent drawn, the draw's seed.
MIN_WORDS, PERCENT, SEED = 20, 5, 42


def crc_table() -> np.ndarray:
    """The CRC of each byte for the reflected polynomial 0xEDB88320."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_TABLE = crc_table()


def crc32s(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:start + length]`` for arrays of starts and lengths."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        group = order[a:b]
        n = int(length[group[0]])
        if n > COLUMNS:
            out[group] = [zlib.crc32(data[s:s + n]) for s in start[group]]
            continue
        matrix = np.lib.stride_tricks.sliding_window_view(data, n)[start[group]] if n else np.zeros((len(group), 0), np.uint8)
        crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
        out[group] = ~crc
    return out


def pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes, int]]:
    """(row, bytes, words carried): texts in pieces of about PIECE bytes, cut between words; a piece
    after the first begins with the last two words before it, which are counted already."""
    for row, text in enumerate(texts):
        carried, at = b"", 0
        while at < len(text) or at == 0:
            end = at + PIECE
            if end < len(text):
                # the first byte from there on that belongs to no word; a word longer than a piece stays whole
                while end < len(text) and not len(gap := np.flatnonzero(~WORD_BYTE[LOWER_BYTE[np.frombuffer(text, np.uint8, min(PIECE, len(text) - end), end)]])):
                    end = min(end + PIECE, len(text))
                end = end + int(gap[0]) if end < len(text) else end
            part = text[at:end]
            old = len(word_spans(np.frombuffer(carried, np.uint8))[0])
            yield row, carried + b" " + part, old
            if end >= len(text):
                break
            start, stop = word_spans(np.frombuffer(carried + b" " + part, np.uint8))
            whole = carried + b" " + part
            carried = b" ".join(whole[s:e] for s, e in zip(start[1 - WORDS:], stop[1 - WORDS:]))
            at = end


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([False], WORD_BYTE[LOWER_BYTE[data]], [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def batches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """(rows, pieces, words carried), about PIECE bytes at once."""
    rows, parts, carried, size = [], [], [], 0
    for row, part, old in pieces(texts):
        if parts and size + len(part) > PIECE:
            yield np.array(rows), parts, np.array(carried)
            rows, parts, carried, size = [], [], [], 0
        rows.append(row)
        parts.append(part)
        carried.append(old)
        size += len(part) + 1
    if parts:
        yield np.array(rows), parts, np.array(carried)


def feature_buckets(rows: np.ndarray, parts: list[bytes], carried: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each new word, row of each feature, its bucket) of the pieces."""
    data = LOWER_BYTE[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    inside = WORD_BYTE[data]
    edge = np.diff(np.concatenate(([False], inside)).view(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none
    # words one space apart: a feature is a slice
    keep = inside.copy()
    keep[stop] = True
    text = np.where(inside, data, 0x20).astype(np.uint8)[keep]
    ends = np.cumsum(stop - start + 1)
    begins = ends - (stop - start + 1)
    size = np.array([len(p) + 1 for p in parts])
    piece = np.searchsorted(np.cumsum(size) - size, start, "right") - 1
    first = np.searchsorted(piece, np.arange(len(parts)))
    new = np.arange(len(start)) - first[piece] >= carried[piece]  # words that no piece before has counted
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(text)]).dictionary_encode()
    ids, n_ids = words.indices.to_numpy().astype(np.int64), len(words.dictionary)

    places, feature_row, at, length, codes = [], [], [], [], ids
    base = 0
    for k in range(1, WORDS + 1):
        if k > 1:
            codes = codes[:-1] * n_ids + ids[k - 1:]
        last = np.arange(k - 1, len(ids))
        here = np.flatnonzero((piece[last] == piece[last - k + 1]) & new[last])  # a feature counts with its last word
        which, distinct = pd.factorize(codes[here])
        one = np.empty(len(distinct), np.int64)
        one[which] = here  # any place of it
        places.append(which + base)
        feature_row.append(rows[piece[last[here]]])
        at.append(begins[one])
        length.append(ends[one + k - 1] - 1 - begins[one])
        base += len(distinct)
    buckets = crc32s(text, np.concatenate(at), np.concatenate(length)) % np.uint32(BUCKETS)
    return rows[piece[new]], np.concatenate(feature_row), buckets[np.concatenate(places)].astype(np.int64)


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``bucket, n`` of the features of all texts; buckets without any are absent."""
    def run(parts):
        total = np.zeros(BUCKETS, np.int64)
        for b in parts:
            for batch in batches(_bytes(b.column(0))):
                total += np.bincount(feature_buckets(*batch)[2], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    rows = docs.select(F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text") -> np.ndarray:
    """What a feature of each bucket adds to a document's weight: thousandths of the log ratio of smoothed frequencies.

    BUCKETS values, whatever the size of the tables.
    """
    counted = bucket_counts(docs, text_col).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        bucket_counts(target, target_text_col).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for r in counted.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():  # BUCKETS rows
        s[r.bucket], t[r.bucket] = r.s, r.t
    all_s, all_t = sum(s) + BUCKETS, sum(t) + BUCKETS
    return np.array([math.floor(1000 * math.log(float(t[i] + 1) * all_s / (float(s[i] + 1) * all_t))) for i in range(BUCKETS)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``_id, _key, n_words, n_features, weight`` of every row."""
    value = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers
    rows = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))

    def run(parts):
        for b in parts:
            texts = _bytes(b.column(2))
            sums = np.zeros((3, len(texts)), np.int64)
            for batch in batches(texts):
                words, features, bucket = feature_buckets(*batch)
                np.add.at(sums[0], *np.unique(words, return_counts=True))
                some, first, n = np.unique(features, return_inverse=True, return_counts=True)
                sums[1][some] += n
                per_row = np.zeros(len(some), np.int64)
                np.add.at(per_row, first, value.value[bucket])
                sums[2][some] += per_row
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, sums)], names=schema.names)

    schema = T.StructType([rows.schema["_id"], rows.schema["_key"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    return rows.mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """A Gumbel draw in thousandths, from the SHA-256 of seed and key; a null key draws as the empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``_place``, their number from 1 in that order, equal rows in any: sorted by ranges over all tasks."""
    # ranges are sampled, so what is sorted is written first; its row numbers part equal rows, however many
    rows = rows.withColumn("_tie", F.monotonically_increasing_id()).checkpoint()
    rows = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    rows = rows.drop("_tie").withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).checkpoint()
    # one row a range, at most the number of shuffle partitions
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_in"), F.min("_at").alias("_zero"))
    counts = counts.select("_range", "_zero", F.expr("sum(_in) OVER (ORDER BY _range ROWS UNBOUNDED PRECEDING) - _in").alias("_before"))
    met = rows.join(F.broadcast(counts), "_range")
    return met.withColumn("_place", F.col("_before") + F.col("_at") - F.col("_zero") + 1).drop("_range", "_at", "_zero", "_before")


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
               percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, _key, n_words, n_features, weight, score, rank`` of every row; rank is null for rows not drawn.

    Of the N rows of at least ``min_words`` words floor(percent * N / 100) are drawn, by falling
    score, then id (a null id last; equal rows in any order). A null text has no words, weight 0 and, like any short
    one, a score but no rank. Repeated rows are rows. An empty target has no features: gains then tell rare buckets from common
    ones. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    scored = weighted(docs, gains(docs, target, text_col, target_text_col), id_col, text_col)
    scored = scored.withColumns({"score": F.col("weight") + noise(F.col("_id"), seed), "_short": F.col("n_words") < min_words})
    placed = numbered(scored, [F.col("_short").asc(), F.col("score").desc(), F.col("_id").asc_nulls_last()])
    drawn = placed.agg(F.expr(f"count_if(NOT _short) * {percent} div 100").alias("k")).scalar()
    return placed.select(F.col("_id").alias("doc_id"), "_key", "n_words", "n_features", "weight", "score",
                         F.when(F.col("_place") <= drawn, F.col("_place")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The drawn rows of ``docs``, all columns kept. Rows of one id and text go together: if one is drawn, all are."""
    key, of = free(docs, "key", "id")
    drawn = importance(docs, target, id_col, text_col, **how).filter("rank IS NOT NULL").select(F.col("doc_id").alias(of), F.col("_key").alias(key)).distinct()
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    return keyed.join(drawn, (keyed[key] == drawn[key]) & keyed[id_col].eqNullSafe(drawn[of]), "left_semi").select(*docs.columns)


def op13_crc_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed by their likeness to the benchmark; five percent of those of twenty words and more are drawn."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tb
  FROM (SELECT unnest(range(256)) AS n)),
w AS (SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT 't', item_id, row_number() OVER (), regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
p AS (SELECT kind, r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
  list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS f FROM w),
u AS (SELECT kind, r, f, count(*) AS n FROM p GROUP BY ALL),
x AS (SELECT DISTINCT f FROM u),
c AS (SELECT f, hex(encode(f)) AS h, 0 AS i, 4294967295::BIGINT AS crc FROM x
  UNION ALL SELECT f, h, i + 1, xor(crc >> 8, tb[xor(crc & 255, ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) + 1]) FROM c, tab WHERE 2 * i < length(h)),
k AS (SELECT f, xor(crc, 4294967295) % 10000 AS b FROM c WHERE 2 * i = length(h)),
v AS (SELECT kind, r, b, sum(n) AS n FROM u JOIN k USING (f) GROUP BY ALL),
g AS (SELECT b, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 't'), 0) AS t FROM v GROUP BY b),
z AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM g),
d AS (SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM v JOIN z USING (b) WHERE kind = 'd' GROUP BY r),
e AS (SELECT id AS doc_id, r, coalesce(len(ws), 0) >= 20 AS long, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296))))::BIGINT AS score
  FROM w LEFT JOIN d USING (r) WHERE kind = 'd'),
o AS (SELECT *, row_number() OVER (PARTITION BY long ORDER BY score DESC, doc_id NULLS LAST) AS place, 5 * count(*) OVER (PARTITION BY long) // 100 AS drawn FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN long AND place <= drawn THEN place END AS rank FROM o
"""
