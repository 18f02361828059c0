"""Benchmark decontamination by winnowing.

Both sides are reduced to fingerprints: of every ``SPAN - K + 1`` successive
K-word hashes of a text the smallest is kept (the rightmost of equals). Two texts
that share SPAN words share such a run of hashes, hence a kept fingerprint at the
same place in it, so every shared span is found. Fingerprints meet in a join, and
each meeting is extended word by word to both sides before it counts. An item of
fewer than SPAN words is one window: its whole word sequence is the fingerprint.

Only document fingerprints that pass a bit table of the benchmark's fingerprints
(a fixed size, whatever the benchmark's) leave their task; the join that follows is
salted, as one passage may stand in a third of all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import LOWER_BYTE, free, mix64, prepare, row_key, runs, table, word_hashes

#: Words of a window and of a fingerprinted gram.
SPAN, K = 10, 5
#: log2 of the bits of the benchmark's bit table (2 MB).
FILTER_BITS = 24
#: Copies of a benchmark fingerprint in the join; a fingerprint of many documents is spread over them.
SALTS = 16
#: Bytes of text hashed at once in a task.
CHUNK = 1 << 20


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x2545F4914F6CDD1D) + words[j:j + n]
    return mix64(out + np.uint64(k))


def winnow(words: np.ndarray, owner: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes that winnowing keeps; grams and windows never cross from one owner to the next."""
    grams = gram_hashes(words, k)
    m = len(grams) - w + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = grams[:m].copy(), np.arange(m)
    for j in range(1, w):
        less = grams[j:j + m] <= best
        best[less] = grams[j:j + m][less]
        at[less] = np.flatnonzero(less) + j
    whole = owner[:m] == owner[w + k - 2:w + k - 2 + m]
    kept = np.unique(at[whole])
    return kept, grams[kept]


def fingerprints(run: list[bytes], lengths: list[int], short_items: bool, passes):
    """(row, words in it, hash, position, gram length, context, gram's place in the context) of a run of texts.

    The context holds every word that a window around the gram can hold. ``lengths``: of items
    shorter than SPAN, whose whole sequence is looked for; ``short_items``: the rows are items,
    and one shorter than SPAN is its own fingerprint. ``passes`` filters hashes.
    """
    data = LOWER_BYTE[np.frombuffer(b"\0".join(run), np.uint8)]
    start, end, words = word_hashes(data)
    sizes = np.array([len(r) + 1 for r in run])
    row_start = np.cumsum(sizes) - sizes
    owner = np.searchsorted(row_start, start, side="right") - 1
    first = np.searchsorted(start, row_start)
    count = np.diff(np.append(first, len(start)))
    raw = data.tobytes()
    text = lambda a, b: b" ".join(raw[s:e] for s, e in zip(start[a:b].tolist(), end[a:b].tolist())).decode("utf-8", "replace")
    found = []

    def emit(at: np.ndarray, hashes: np.ndarray, k: int, reach: int) -> None:
        ok = passes(hashes)
        for p, h in zip(at[ok].tolist(), hashes[ok].astype(np.int64).tolist()):
            r = int(owner[p])
            lo, hi = max(int(first[r]), p - reach), min(int(first[r] + count[r]), p + k + reach)
            found.append((r, h, p - int(first[r]), k, text(lo, hi), p - lo))

    emit(*winnow(words, owner, K, SPAN - K + 1), K, SPAN - K)
    for n in range(1, SPAN) if short_items else lengths:
        grams = gram_hashes(words, n)
        here = np.arange(len(grams))
        whole = owner[here] == owner[here + n - 1] if len(grams) else here.astype(bool)
        if short_items:
            whole &= count[owner[here]] == n
        emit(here[whole], grams[whole], n, 0)
    return count, found


_OUT = "_id long, _key long, _words long, _hash long, _pos int, _k int, _ctx string, _at int"


def _item_pass(batches):
    for b in batches:
        ids, rows = b.column(0), {n: [] for n in ("item", "hash", "k", "ctx", "at")}
        texts = b.column(1).cast(pa.binary()).to_pylist()
        for base, run in runs([t or b"" for t in texts], CHUNK):
            _, found = fingerprints(run, [], True, lambda h: np.ones(len(h), bool))
            for r, h, _, k, ctx, at in found:
                for n, v in zip(rows, (ids[base + r].as_py(), h, k, ctx, at)):
                    rows[n].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["item"], pa.string()), pa.array(rows["hash"], pa.int64()), pa.array(rows["k"], pa.int32()),
             pa.array(rows["ctx"], pa.string()), pa.array(rows["at"], pa.int32())], names=["_item", "_hash", "_k", "_ictx", "_iat"])


def item_fingerprints(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = items.select(F.col(id_col).cast("string").alias("_item"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(_item_pass, "_item string, _hash long, _k int, _ictx string, _iat int").distinct()


def bit_table(hashes: DataFrame) -> np.ndarray:
    """A bit for the top FILTER_BITS bits of each hash; the driver gets 2**FILTER_BITS / 64 words at most."""
    slot = F.shiftrightunsigned("_hash", 64 - FILTER_BITS)
    words = hashes.groupBy(F.shiftrightunsigned(slot, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_hash, {64 - FILTER_BITS}) & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for w, bits in words.collect():
        out[w] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)
    return out


def _doc_pass(bits, lengths: list[int]):
    def passes(h: np.ndarray) -> np.ndarray:
        slot = (h >> np.uint64(64 - FILTER_BITS))
        return (bits.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)

    def run_pass(batches):
        for b in batches:
            keys = b.column(0)
            texts = b.column(1).cast(pa.binary()).to_pylist()
            row, cols = [], {n: [] for n in ("words", "hash", "pos", "k", "ctx", "at")}
            for base, run in runs([t or b"" for t in texts], CHUNK):
                count, found = fingerprints(run, lengths, False, passes)
                row += range(base, base + len(run))
                cols["words"] += count.tolist()
                for n in ("hash", "pos", "k", "ctx", "at"):
                    cols[n] += [None] * len(run)
                for r, *values in found:
                    row.append(base + r)
                    cols["words"].append(None)
                    for n, v in zip(("hash", "pos", "k", "ctx", "at"), values):
                        cols[n].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64()))] + [pa.array(v, t) for v, t in zip(cols.values(), kinds)],
                                             names=["_key", "_words", "_hash", "_pos", "_k", "_ctx", "_at"])
    return run_pass


def _extended() -> dict:
    """Equal words to the left and right of the gram; both are null in a row without a partner."""
    def equal(lo: int, hi: int) -> str:
        return (f"array_join(transform(sequence({lo}, {hi}), j -> "
                "if(coalesce(get(_a, _at + j) = get(_b, _iat + j), false), '1', '0')), '')")
    left = F.when(F.col("_k") < K, 0).otherwise(F.length(F.regexp_extract(F.expr(equal(-(SPAN - K), -1)), "(1*)$", 1)))
    return {"_left": left, "_eq": F.length(F.regexp_extract(F.expr(equal(0, SPAN + SPAN)), "^(1*)", 1))}


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per distinct document row: ``_key, doc_id, _copies, n_words, spans, items``.

    ``spans``: merged [start, end) word ranges inside some occurrence of an item window;
    ``items``: ids, as sorted strings, of the items with occurring windows. A null or
    empty text has no words and no hits; an empty benchmark hits nothing. An item without
    an id hits words but is not listed. ``_copies`` counts equal rows of the input.
    """
    spark = prepare(docs.sparkSession)
    grams = item_fingerprints(items, item_id, item_text).checkpoint()
    lengths = sorted(r[0] for r in grams.select("_k").distinct().collect())  # SPAN values at most
    bits = spark.sparkContext.broadcast(bit_table(grams))
    # items shorter than SPAN but of K words are told from others by their context, the K words alone
    short = sorted(set(lengths) - {K} | ({K} if not grams.filter((F.col("_k") == K) & (F.size(F.split("_ictx", " ")) == K)).isEmpty() else set()))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.select("doc_id", row_key("doc_id", "_text").alias("_key"), "_text")
    id_type = rows.schema["doc_id"].dataType
    named = rows.select(F.struct(F.col("_key").alias("k"), F.col("doc_id").alias("d")).alias("_key"), "_text")
    out = T.StructType([T.StructField("_key", T.StructType([T.StructField("k", T.LongType()), T.StructField("d", id_type)]))]
                       + list(T._parse_datatype_string("_words long, _hash long, _pos int, _k int, _ctx string, _at int")))
    found = named.mapInArrow(_doc_pass(bits, short), out).select(
        F.col("_key.k").alias("_key"), F.col("_key.d").alias("doc_id"), "_words", "_hash", "_pos", "_k", "_ctx", "_at")
    # a document's own row has no partner: it is dealt by its key, under a salt that no fingerprint has
    found = found.withColumns({"_salt": F.when(F.col("_hash").isNull(), F.lit(-1)).otherwise(F.pmod("_key", F.lit(SALTS))).cast("int"),
                               "_hash": F.coalesce("_hash", "_key")})

    classes = grams.withColumn("_class", F.xxhash64("_ictx", "_iat", "_k"))
    every_salt = F.explode(F.expr(f"sequence(0, {SALTS - 1})"))
    partners = classes.select("_hash", F.col("_k").alias("_ik"), "_ictx", "_iat", "_class").distinct().withColumn("_salt", every_salt)
    met = found.join(partners, ["_hash", "_salt"], "left").withColumns({"_a": F.split("_ctx", " "), "_b": F.split("_ictx", " ")})
    met = met.withColumns(_extended())
    need = F.when(F.size("_b") < SPAN, F.size("_b")).otherwise(F.lit(SPAN))
    real = F.coalesce((F.col("_k") == F.col("_ik")) & (F.col("_eq") >= F.col("_k")) & (F.col("_left") + F.col("_eq") >= need), F.lit(False))
    span = F.struct((F.col("_pos") - F.col("_left")).alias("start"), (F.col("_pos") + F.col("_eq")).alias("end"))
    per_doc = met.groupBy("_key", "doc_id").agg(
        F.max("_words").alias("n_words"), F.count("_words").alias("_copies"),
        F.array_sort(F.collect_set(F.when(real, span))).alias("_spans"),
        F.collect_set(F.when(real, F.col("_class"))).alias("_classes"))
    merged = F.expr(
        "aggregate(_spans, cast(array() as array<struct<start:int,end:int>>), (acc, x) -> "
        "if(size(acc) > 0 and x.start <= element_at(acc, -1).end, "
        "concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end)))), "
        "concat(acc, array(named_struct('start', x.start, 'end', x.end)))))")
    per_doc = per_doc.select("_key", "doc_id", "n_words", "_copies", merged.alias("spans"), F.explode_outer("_classes").alias("_class"))
    per_doc = per_doc.withColumns({"_salt": F.when(F.col("_class").isNull(), F.lit(-1)).otherwise(F.pmod("_key", F.lit(SALTS))).cast("int"),
                                   "_class": F.coalesce("_class", "_key")})
    members = classes.select("_class", "_item").distinct().withColumn("_salt", every_salt)
    return per_doc.join(members, ["_class", "_salt"], "left").groupBy("_key", "doc_id", "n_words", "_copies", "spans").agg(
        F.array_sort(F.collect_set("_item")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns, whatever these are called.

    Null and empty texts hold no window and stay; equal rows go or stay together. Items without words find nothing, so an
    empty item table keeps all rows; an empty table gives an empty result.
    """
    key, dirty_key, dirty_id = free(docs, "key", "dirty", "id")
    dirty = hits(docs, items, id_col, text_col, **names).filter(F.size("spans") > 0).select(F.col("_key").alias(dirty_key), F.col("doc_id").alias(dirty_id))
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    same = (F.col(key) == F.col(dirty_key)) & F.col(id_col).eqNullSafe(F.col(dirty_id))
    return keyed.join(dirty, same, "left_anti").select(*docs.columns)


def op1_winnowing(spark, sf_dir: str) -> DataFrame:
    """Words of whole documents inside windows of 10 benchmark words, and the items they come from."""
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.end - x.start)")
    out = found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"), F.explode(F.expr("sequence(1L, _copies)")).alias("_copy"))
    return out.drop("_copy")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN iw USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""
