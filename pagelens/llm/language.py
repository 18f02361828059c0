"""Language identification by a convolutional network over bytes.

A text's bytes (A-Z in lower case) are cut into windows of WINDOW bytes that together
cover it. Filters of several widths slide over a window's byte embeddings, each
filter's largest response is kept, and a softmax layer turns these into languages; a
document's probabilities are the mean of its windows', weighted by their bytes. The network is
trained in numpy, by the driver, on windows of a bounded sample of labelled documents.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import LOWER_BYTE, SPARE, draw, prepare, runs, table

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 12, 8
#: Documents of each language that are learned from, windows of each; with many languages fewer documents of each, about so many in all.
TRAIN_PER_LANG, TRAIN_WINDOWS, TRAIN_DOCS = 400, 4, 80_000
#: Ranked of each language besides: by chance of the draws none of them comes out about once in e ** 40 times.
LEAST_RANKED = 40
EPOCHS, BATCH = 8, 128
#: Bytes of text a task works on at once.
CHUNK = 1 << 17
UNKNOWN = "und"


def windows(data: bytes) -> np.ndarray:
    """The text's windows, zero-padded; successive ones overlap by the widest filter less one byte."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    flat = np.zeros((n - 1) * step + WINDOW, np.uint8)
    flat[:len(data)] = LOWER_BYTE[np.frombuffer(data, np.uint8)]
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[::step]


class Net:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, labels: list[str]):
        draw = np.random.default_rng(5)
        self.labels = labels
        self.p = {"e": draw.normal(0, 0.5, (256, EMBED))}
        for w in WIDTHS:
            self.p[f"f{w}"] = draw.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p["s"] = draw.normal(0, 0.1, (FILTERS * len(WIDTHS), len(labels)))
        self.p["c"] = np.zeros(len(labels))

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        draw = np.random.default_rng(6)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        t = 0
        for _ in range(EPOCHS):
            order = draw.permutation(len(x))
            for a in range(0, len(order), BATCH):
                at = order[a:a + BATCH]
                t += 1
                for k, g in self.gradient(x[at], y[at]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - 0.01 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict:
        p, n = self.p, len(x)
        emb = p["e"][x]
        cols, best, hidden = {}, {}, []
        for w in WIDTHS:
            cols[w] = np.concatenate([emb[:, j:WINDOW - w + 1 + j] for j in range(w)], axis=2)
            out = cols[w] @ p[f"f{w}"]
            best[w] = out.argmax(axis=1)
            hidden.append(np.maximum(np.take_along_axis(out, best[w][:, None], 1)[:, 0] + p[f"b{w}"], 0))
        h = np.concatenate(hidden, axis=1)
        z = h @ p["s"] + p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        g = {"s": h.T @ q, "c": q.sum(0), "e": np.zeros_like(p["e"])}
        dh = (q @ p["s"].T) * (h > 0)
        for i, w in enumerate(WIDTHS):
            d = dh[:, i * FILTERS:(i + 1) * FILTERS]
            picked = np.take_along_axis(cols[w], best[w][:, :, None], 1)  # n, filters, w * EMBED
            g[f"f{w}"] = np.einsum("nf,nfk->kf", d, picked)
            g[f"b{w}"] = d.sum(0)
            back = (d[:, :, None] * p[f"f{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            for j in range(w):
                np.add.at(g["e"], x[np.arange(n)[:, None], best[w] + j], back[:, :, j])
        return g

    def tables(self) -> dict:
        """For each width and place, every byte's share of every filter: embedding and filter in one look-up."""
        return {w: [(self.p["e"] @ self.p[f"f{w}"][j * EMBED:(j + 1) * EMBED]).astype(np.float32) for j in range(w)] for w in WIDTHS}

    def probabilities(self, x: np.ndarray, tables: dict) -> np.ndarray:
        hidden = []
        flat = np.ascontiguousarray(x)
        for w in WIDTHS:
            out = tables[w][0][flat[:, :WINDOW - w + 1]]
            for j in range(1, w):
                out += tables[w][j][flat[:, j:WINDOW - w + 1 + j]]
            hidden.append(np.maximum(out.max(axis=1) + self.p[f"b{w}"], 0))
        z = np.concatenate(hidden, axis=1) @ self.p["s"] + self.p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        return q / q.sum(1, keepdims=True)


def per_language(n: int) -> int:
    """Documents to learn from of each of n languages; every language has one at least."""
    return min(TRAIN_PER_LANG, max(1, TRAIN_DOCS // n))


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Net | None:
    """The network learned from windows spread over the texts of a sample; None without labelled texts."""
    # octet_length of null is null: rows without text are not counted either
    rows = docs.filter(F.col(lang_col).isNotNull() & (F.octet_length(F.col(text_col).cast("string")) > 0) & learn(F.col(id_col))).select(
        F.col(lang_col).cast("string").alias("_lang"), draw(id_col, text_col).alias("_h"), F.col(text_col).cast("string").cast("binary").alias("_b"))
    langs = {r[0]: r[1] for r in rows.groupBy("_lang").count().collect()}
    if not langs:
        return None
    wanted = per_language(len(langs))
    # the smallest draws of each language: about SPARE times the wanted rows are ranked, however many there are, and enough
    # that no language is left without any
    share = F.create_map(*[F.lit(v) for lang, n in langs.items() for v in (lang, (SPARE * wanted + LEAST_RANKED) / n)])
    order = Window.partitionBy("_lang").orderBy("_h")
    size = F.octet_length("_b")
    last = F.greatest(size - WINDOW, F.lit(0))
    cuts = F.array(*[F.substring(F.col("_b"), F.lit(1) + (last * F.lit(i) / F.lit(max(1, TRAIN_WINDOWS - 1))).cast("int"), F.lit(WINDOW)) for i in range(TRAIN_WINDOWS)])
    chosen = rows.filter(F.col("_h") < F.try_element_at(share, F.col("_lang"))).select("_lang", "_h", cuts.alias("_w"))
    chosen = chosen.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= wanted)
    got = sorted((r[0], r[1], [bytes(w) for w in r[2]]) for r in chosen.select("_lang", "_h", "_w").collect())  # about TRAIN_DOCS rows
    labels = sorted({r[0] for r in got})
    if not labels:
        return None
    number = {lang: y for y, lang in enumerate(labels)}
    pairs = sorted({(number[lang], w) for lang, _, ws in got for w in ws if w})
    net = Net(labels)
    if len(labels) > 1:
        net.fit(np.concatenate([windows(w)[:1] for _, w in pairs]), np.array([y for y, _ in pairs]))
    return net


def predict(texts: list[str | None], net: Net, tables: dict) -> tuple[list[str], list[float]]:
    out, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    known = [(i, t.encode()) for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    for base, run in runs([t for _, t in known], CHUNK):
        cut = [windows(t) for t in run]
        n = [len(c) for c in cut]
        weight = np.concatenate([np.minimum(WINDOW, len(t) - np.arange(k) * (WINDOW - max(WIDTHS) + 1)) for t, k in zip(run, n)]).astype(float)[:, None]
        first, of = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        mean, all_windows = np.zeros((len(n), len(net.labels))), np.concatenate(cut)
        for part in np.array_split(np.arange(len(of)), max(1, len(of) // 512)):  # a long text times many languages is never held whole
            start = np.flatnonzero(np.diff(of[part], prepend=-1))
            mean[of[part[start]]] += np.add.reduceat(net.probabilities(all_windows[part[0]:part[-1] + 1], tables) * weight[part], start, axis=0)
        mean /= np.add.reduceat(weight, first, axis=0)
        for k, (best, p) in enumerate(zip(mean.argmax(1).tolist(), mean.max(1).tolist())):
            out[known[base + k][0]], score[known[base + k][0]] = net.labels[best], min(p, 1.0)
    return out, score


def languages(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row.

    ``und`` with score 0 where the text is null or has no letter (and everywhere, if
    nothing can be learned). Repeated rows give repeated rows, an empty table an empty result.
    """
    prepare(docs.sparkSession)
    net = train(docs, learn, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        tables = net and net.tables()  # the network, a few thousand numbers, comes with the function
        for b in batches:
            texts = b.column(1).to_pylist()
            lang, score = predict(texts, net, tables) if net else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def learned(i):
    """Ids whose CRC does not divide by five are learned from."""
    return F.crc32(i.cast("string").cast("binary")) % 5 != 0


def op7_byte_convolution(spark, sf_dir: str) -> DataFrame:
    """The language of every whole document; a fifth of the ids is held out."""
    out = languages(table(spark, sf_dir, "documents"), learned)
    return out.select("doc_id", F.coalesce(~learned(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
