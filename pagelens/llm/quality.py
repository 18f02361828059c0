"""Quality classifier: random-indexing word vectors pooled per document and a two-layer network.

Every word (a run of letters and digits, or of other signs) falls into one of BUCKETS by a
hash of its bytes. A bucket has a fixed sparse ternary index vector; a word vector is the sum of
the index vectors of its neighbours over the whole corpus, so it is made of integer counts of fixed
size that add up exactly in any order. A document pools its words' vectors: their mean, their spread and
the mean step from one word to the next. A network of two layers, trained in numpy on a bounded sample of
labelled documents, scores the pooled vector; its temperature is fitted on a part of the sample kept back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import SPARE, _powers, draw, free, mix64, prepare, runs, table

#: Word buckets (a power of two), dimensions, nonzero places of an index vector, neighbours to each side.
BUCKETS, DIMS, NONZERO, REACH = 1 << 14, 32, 2, 2
#: Labelled documents of each class that are learned from at most, units of the hidden layer, training steps.
TRAIN_PER_CLASS, HIDDEN, STEPS = 1500, 24, 400
#: Rows of the word-vector table that are summed together, and bytes of text a task works on at once.
TABLE_ROWS, CHUNK = 256, 1 << 19

_KIND = np.full(256, 2, np.uint8)  # 0 blank, 1 letter or digit, 2 other sign
_KIND[[9, 10, 11, 12, 13, 32, 0]] = 0
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _KIND[_lo:_hi] = 1


def words(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word of a run of texts."""
    data = np.frombuffer(b"\0".join(run) + b"\0", np.uint8)
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(kind)) + 1
    start = np.concatenate(([0], edge))
    end = np.append(edge, len(data))
    word = kind[start] > 0
    start, end = start[word], end[word]
    up, down = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    bucket = (mix64((sums[end] - sums[start]) * down[start]) & np.uint64(BUCKETS - 1)).astype(np.int64)
    size = np.array([len(r) + 1 for r in run])
    return bucket, np.searchsorted(np.cumsum(size), start, side="right")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    draw = np.random.default_rng(7)
    return draw.integers(0, DIMS, (BUCKETS, NONZERO)), draw.choice(np.array([-1, 1]), (BUCKETS, NONZERO))


def context_sums(bucket: np.ndarray, row: np.ndarray, into: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to each word's vector the index vectors of its neighbours in the same text."""
    for d in range(1, REACH + 1):
        same = row[:-d] == row[d:]
        left, right = bucket[:-d][same], bucket[d:][same]
        for word, near in ((left, right), (right, left)):
            for k in range(NONZERO):
                at = word * DIMS + places[near, k]
                plus = signs[near, k] > 0
                into += np.bincount(at[plus], minlength=BUCKETS * DIMS) - np.bincount(at[~plus], minlength=BUCKETS * DIMS)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The normalised word vectors of the whole corpus: BUCKETS x DIMS numbers, whatever its size."""
    def count(batches):
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMS, np.int64)
        for b in batches:
            for _, run in runs([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()], CHUNK):
                context_sums(*words(run), total, places, signs)
        if total.any():
            part = total.reshape(-1, TABLE_ROWS * DIMS)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(part)), pa.int32()), pa.array([p.astype("<i8").tobytes() for p in part], pa.binary())], names=["part", "sums"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[p] = total.get(p, 0) + np.frombuffer(s, "<i8")
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["part", "sums"])

    kind = "part int, sums binary"
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(count, kind).repartition(BUCKETS // TABLE_ROWS, "part").mapInArrow(add, kind)
    out = np.zeros((BUCKETS // TABLE_ROWS, TABLE_ROWS * DIMS))
    for p, s in parts.collect():  # BUCKETS x DIMS numbers in all
        out[p] += np.frombuffer(s, "<i8")
    out = out.reshape(BUCKETS, DIMS)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and mean step of the word vectors of each text, and the log of its number of words."""
    out = np.zeros((len(texts), 3 * DIMS + 1), np.float32)
    for base, run in runs(texts, CHUNK):
        bucket, row = words(run)
        if not len(row):
            continue
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        n = np.diff(np.append(first, len(row))).astype(np.float32)[:, None]
        at = base + row[first]
        v = vectors[bucket]
        mean = np.add.reduceat(v, first, axis=0) / n
        out[at, :DIMS] = mean
        out[at, DIMS:2 * DIMS] = np.sqrt(np.maximum(np.add.reduceat(v * v, first, axis=0) / n - mean * mean, 0))
        step = np.zeros_like(v)
        np.abs(v[1:] - v[:-1], out=step[:-1])
        step[:-1][row[1:] != row[:-1]] = 0
        out[at, 2 * DIMS:3 * DIMS] = np.add.reduceat(step, first, axis=0) / np.maximum(n - 1, 1)
        out[at, -1] = np.log1p(n[:, 0])
    return out


class Network:
    """Two layers on standardised inputs, trained by Adam; probabilities are calibrated by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS):
        self.shift, self.scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (0.0, 1.0)
        self.temperature, self.constant = 1.0, None
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        draw = np.random.default_rng(11)
        x, y = (x - self.shift) / self.scale, y.astype(np.float64)
        kept = draw.random(len(y)) < 0.2
        if not all(0 < y[p].mean() < 1 for p in (kept, ~kept) if p.any()) or not kept.any():
            kept[:] = False
        xt, yt = x[~kept], y[~kept]
        weight = np.where(yt == 1, 0.5 / yt.mean(), 0.5 / (1 - yt.mean()))
        w = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), draw.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        for step in range(1, steps + 1):
            h = np.tanh(xt @ w[0] + w[1])
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            d = weight * (p - yt) / len(yt)
            dh = np.outer(d, w[2]) * (1 - h * h)
            grad = [xt.T @ dh + 1e-4 * w[0], dh.sum(0), h.T @ d + 1e-4 * w[2], np.array([d.sum()])]
            for i, g in enumerate(grad):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.w = w
        if kept.any():
            z, t = self.logit(x[kept]), y[kept]
            loss = lambda k: np.mean(np.logaddexp(0, z / k) - t * z / k)
            self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self.logit((x - self.shift) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _pool(docs: DataFrame, columns: list[str], text_col: str, vectors) -> DataFrame:
    def run(batches):
        for b in batches:
            x = pooled([t or b"" for t in b.column(len(columns)).cast(pa.binary()).to_pylist()], vectors.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(columns)], pa.array(list(x.astype(np.float64)), pa.list_(pa.float64()))], names=[*columns, "x"])

    rows = docs.select(*columns, F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema[:-1], T.StructField("x", T.ArrayType(T.DoubleType()))]))


def sample(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", label: str = "quality", per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """``_id, _y``: up to ``per_class`` labelled ids of each class, in the order of a hash; ids labelled both ways are left out."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)").filter(learn(F.col("_id")))
    marks = marks.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).filter("_y = _z")
    marks = marks.join(docs.select(F.col(id_col).alias("_id")), "_id", "left_semi")
    # the smallest draws of each class: about SPARE times the wanted ids are ranked, however many there are
    marks = marks.select("_id", "_y", draw("_id").alias("_h"))
    size = dict(marks.groupBy("_y").count().collect())

    def of(y: int) -> DataFrame:
        share = SPARE * per_class / max(1, size.get(y, 0))
        return marks.filter((F.col("_y") == y) & (F.col("_h") < share)).orderBy("_h", "_id").limit(per_class).select("_id", "_y")

    return of(0).unionByName(of(1))


def train(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, Network]:
    """Word vectors of all documents and the network learned from the sample (its pooled vectors come to the driver)."""
    spark = prepare(docs.sparkSession)
    vectors = word_vectors(docs, text_col)
    marks = {i: y for i, y in sample(docs, labels, learn, id_col).collect()}
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")).join(
        F.broadcast(spark.createDataFrame([(i,) for i in marks], T.StructType([T.StructField("_id", docs.schema[id_col].dataType)]))), "_id")
    # an id that several rows share counts once: of its texts the first in order
    chosen = chosen.groupBy("_id").agg(F.min("_body").alias("_body"))
    got = sorted(_pool(chosen, ["_id"], "_body", spark.sparkContext.broadcast(vectors)).collect())
    x = np.array([r[1] for r in got]).reshape(-1, 3 * DIMS + 1)
    return vectors, Network(x, np.array([marks[r[0]] for r in got]))


def quality(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and, as the last column under a name that is free, ``__score``: the calibrated probability of label 1.

    ``learn`` tells from an id whether its label may be learned. A null or empty text has the
    zero vector and is scored like any other; without labels of both classes the score is
    the share of label 1 (0.5 without labels). Repeated rows give repeated rows, an empty table an empty result.
    """
    spark = prepare(docs.sparkSession)
    vectors, net = train(docs, labels, learn, id_col, text_col)
    score_col, = free(docs, "__score")
    kept = spark.sparkContext.broadcast(vectors)  # BUCKETS x DIMS numbers; the network comes with the function

    def run(batches):
        for b in batches:
            at = b.schema.names.index(text_col)
            x = pooled([t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()], kept.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(net.score(x.astype(np.float64)))], names=[*b.schema.names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(score_col, T.DoubleType())]))


def learned(i):
    """Labels of ids whose CRC leaves 0 or 2 by three are learned from."""
    return F.crc32(i.cast("string").cast("binary")) % 3 != 1


def op9_random_indexing(spark, sf_dir: str) -> DataFrame:
    """The quality of every whole document; labels of a third of the ids are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality(docs, table(spark, sf_dir, "labels"), learned)
    return out.select("doc_id", F.coalesce(~learned(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= 0.5).cast("int").alias("predicted"))
