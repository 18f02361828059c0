"""Token counts by rank-synchronous merging of ragged arrays.

A task holds the distinct pre-tokens of a run of texts as one flat array of symbols
with an owner per symbol. In every round each sequence applies its own lowest-rank
pair, at all places at once; sequences without a known pair leave the arrays with
their number of symbols.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import prepare, runs, table, worker_cache
from pagelens.llm.pretokens import splitter

#: Characters of text whose pre-tokens a task holds at once, and pre-tokens whose counts it keeps.
RUN_CHARS, KEPT = 1 << 21, 500_000
#: Over this many tokens a document is over the limit.
LIMIT = 512

_NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies (the public rule)."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """The merge list as sorted arrays: pair key, rank, merged symbol."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        vocab = model["vocab"]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.symbol = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (_NONE if no merge) and place of each pair."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE), at

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word."""
        size = np.array([len(w) for w in words], np.int64)
        out = size.copy()
        sym = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        while len(sym):
            rank = np.full(len(sym), _NONE, np.int32)
            at = np.zeros(len(sym), np.int64)
            inside = owner[:-1] == owner[1:]
            rank[:-1], at[:-1] = self.look_up(sym[:-1], sym[1:])
            rank[:-1][~inside] = _NONE
            first = np.flatnonzero(np.concatenate(([True], ~inside)))
            length = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            out[owner[first]] = length
            best = np.repeat(least, length)
            hit = (rank == best) & (best != _NONE)
            # a run of hits is one symbol repeated: every other place of it merges, from the left
            place = np.arange(len(sym))
            begins = hit & ~np.concatenate(([False], hit[:-1] & inside))
            run = np.maximum.accumulate(np.where(begins, place, 0))
            hit &= (place - run) % 2 == 0
            sym[hit] = self.symbol[at[hit]]
            alive = best != _NONE
            alive[1:] &= ~hit[:-1]
            sym, owner = sym[alive], owner[alive]
        return out


def merges(spec: str) -> Merges:
    cache = worker_cache().setdefault("merges", {})
    if hash(spec) not in cache:
        cache[hash(spec)] = Merges(spec)
    return cache[hash(spec)]


def text_counts(texts: list[str | None], spec: str) -> list[int]:
    """Tokens of each text; counts of pre-tokens are kept by the worker, up to a bound."""
    split, merge = splitter(spec), merges(spec)
    kept = worker_cache().setdefault(("counts", hash(spec)), {s: 1 for s in split.special})
    out = []
    for _, run in runs(texts, RUN_CHARS):
        tokens = [split(t) for t in run]
        new = list(set().union(*tokens) - kept.keys())
        if len(kept) + len(new) > KEPT:
            kept.clear()
            kept.update({s: 1 for s in split.special})
            new = list(set().union(*tokens) - kept.keys())
        if new:
            kept.update(zip(new, merge.counts([w.encode() for w in new]).tolist()))
        out += [sum(map(kept.__getitem__, t)) for t in tokens]
    return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; a null text counts as empty (0, 0).

    ``path``: a byte-level BPE in the tokenizers library's JSON format; it is read once, by the driver.
    Rows are independent: repeated rows give repeated rows, an empty table an empty result.
    """
    spark = prepare(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary: a fixed size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(text_counts(texts, spec.value), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]))


def op8_ragged_merging(spark, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under byte_bpe_50k.json, and whether they are over 512."""
    import public_tokenizers
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
