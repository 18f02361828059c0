"""BPE encoding and decoding through a table of distinct words.

Texts are split in tasks into packs: a pack lists its own distinct words, in buckets of a
word hash, and holds its documents as numbers of these words. The lists meet in one shuffle
by bucket, where each distinct word of the corpus is encoded once; a bucket's ids go back to the
packs that sent its words, and each document's ids are read off by position. Decoding joins ids
with the id-to-piece table, whose size is the vocabulary's.

Every pack sends one compressed list to every bucket, so no word, however frequent, makes a task
larger than others; packs have a bounded size, and documents travel as compressed word numbers.
The documents are split twice (once for the lists, once for the numbers) rather than shuffled twice;
a digest of its words tells that both times gave the same pack, else the job fails.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import prepare, table, worker_cache
from pagelens.llm.pretokens import splitter

#: Words of a pack and of one of its pieces (a piece ends with a document, so a longer document is a piece of its own).
PACK_WORDS, PIECE_WORDS = 5_000_000, 200_000
#: Buckets of the distinct-word table; a task holds the distinct words of one bucket, up to a bound, to encode each once.
BUCKETS, HELD_WORDS = 512, 2_000_000


def shrink(numbers: np.ndarray) -> bytes:
    """Numbers below 2**24 as three compressed planes of bytes."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def expand(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(3, -1).astype(np.int64)
    return planes[0] | planes[1] << 8 | planes[2] << 16


class Pack:
    """Documents as numbers of the pack's distinct words."""

    def __init__(self):
        self.number: dict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.docs, self.sizes, self.found = [], [], []

    def add(self, doc, words: list[str]) -> None:
        self.docs.append(doc)
        self.sizes.append(len(words))
        self.found.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))

    def listed(self) -> tuple[list[tuple[int, list[str]]], np.ndarray, int]:
        """(the words by bucket, the number of each listed word, a digest of the list)."""
        words = list(self.number)
        bucket = np.array([zlib.crc32(w.encode()) % BUCKETS for w in words], np.int64)
        order = np.lexsort((np.array(words, object), bucket)) if words else np.zeros(0, np.int64)
        out, digest = [], 0
        cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=BUCKETS))
        for a, e in zip(cut, cut[1:]):
            part = [words[i] for i in order[a:e].tolist()]
            digest = zlib.crc32("\n".join(part).encode(), digest)
            out.append((int(bucket[order[a]]), part))
        return out, order, digest

    def pieces(self, order: np.ndarray):
        """(places in the list of the words by falling frequency, [(documents, their sizes, their words by that rank)])."""
        every = np.concatenate(self.found) if self.found else np.zeros(0, np.int32)
        by_count = np.argsort(-np.bincount(every, minlength=len(order)), kind="stable")
        rank, place = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        rank[by_count], place[order] = np.arange(len(order)), np.arange(len(order))
        pieces, first, got = [], 0, 0
        for i, n in enumerate(self.sizes):
            got += n
            if got >= PIECE_WORDS or i == len(self.sizes) - 1:
                pieces.append((self.docs[first:i + 1], self.sizes[first:i + 1], shrink(rank[np.concatenate(self.found[first:i + 1])])))
                first, got = i + 1, 0
        return place[by_count], pieces


_NAMES = ["pack", "part", "digest", "docs", "sizes", "blob"]


def _schema(id_type: T.DataType) -> T.StructType:
    """part: 0 to BUCKETS - 1 words or ids of a bucket, BUCKETS the order of frequency, then the pieces."""
    return T.StructType([T.StructField("pack", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("digest", T.LongType()),
                         T.StructField("docs", T.ArrayType(id_type)), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("blob", T.BinaryType())])


def _packing(spec, words_only: bool):
    def run(batches):
        split = splitter(spec.value)
        task = 0
        now, held, serial, id_type = Pack(), 0, 0, None

        def batch(digest: int, rows: list[tuple]):
            """rows: (part, documents, sizes, blob)"""
            part, docs, sizes, blob = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | serial] * len(rows), pa.int64()), pa.array(part, pa.int32()), pa.array([digest] * len(rows), pa.int64()),
                 pa.array(docs, pa.list_(id_type)), pa.array(sizes, pa.list_(pa.int32())), pa.array(blob, pa.binary())], names=_NAMES)

        def closed():
            nonlocal now, held, serial
            listed, order, digest = now.listed()
            if words_only:
                if listed:
                    yield batch(digest, [(bucket, None, None, zstandard.compress("\n".join(words).encode())) for bucket, words in listed])
            else:
                places, pieces = now.pieces(order)
                yield batch(digest, [(BUCKETS, None, None, shrink(places)), *((i, *p) for i, p in enumerate(pieces, BUCKETS + 1))])
            now, held, serial = Pack(), 0, serial + 1

        for b in batches:
            id_type = b.column(0).type
            task = b.column(2)[0].as_py() if b.num_rows else task
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = split(text.as_py())
                now.add(doc, words)
                held += len(words) + 1
                if held >= PACK_WORDS:
                    yield from closed()
        if now.docs:
            yield from closed()

    return run


def word_ids(words: list[str], spec: str) -> list[list[int]]:
    """The ids of each pre-token by the library's own merges."""
    cache = worker_cache().setdefault("encoders", {})
    if hash(spec) not in cache:
        import os

        from tokenizers import Tokenizer, pre_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Tokenizer.from_str(spec)
        encoder.no_truncation()
        encoder.no_padding()
        if encoder.normalizer is not None:  # words come normalised and split
            from tokenizers import normalizers
            encoder.normalizer = normalizers.Sequence([])
            encoder.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        cache[hash(spec)] = encoder
    return [e.ids for e in cache[hash(spec)].encode_batch(words, add_special_tokens=False)]


def _encoding(spec):
    """Lists arrive sorted by bucket: each distinct word of a bucket is encoded once."""
    def run(batches):
        bucket, known = None, {}
        for b in batches:
            blobs = []
            for part, blob in zip(b.column("part").to_pylist(), b.column("blob").to_pylist()):
                if part != bucket or len(known) > HELD_WORDS:
                    bucket, known = part, {}
                words = zstandard.decompress(blob).decode().split("\n")
                new = [w for w in words if w not in known]
                known.update(zip(new, (np.array(i, "<u4").tobytes() for i in word_ids(new, spec.value))))
                ids = [known[w] for w in words]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                blobs.append(shrink(np.concatenate(([len(ids)], sizes, np.frombuffer(b"".join(ids), "<u4")))))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in _NAMES[:-1]), pa.array(blobs, pa.binary())], names=_NAMES)

    return run


def ragged(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start:start + size] of each entry, one after the other."""
    before = np.cumsum(size) - size
    return values[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def _reading(spec, decode: bool):
    """Rows arrive by pack and part: the ids of its words, the order of frequency, its pieces."""
    def run(batches):
        pieces = piece_table(spec.value) if decode else None
        pack, sizes, ids, digests, size, start, flat = None, [], [], set(), None, None, None
        for b in batches:
            for pack_, part, digest, docs, n_words, blob in zip(*(b.column(n) for n in _NAMES)):
                numbers = expand(blob.as_py())
                if pack_ != pack:
                    pack, sizes, ids, digests = pack_, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], set()
                digests.add(digest.as_py())
                if len(digests) > 1:
                    raise RuntimeError("the documents changed between two reads; encode() needs a table or a checkpoint")
                if part.as_py() < BUCKETS:
                    n = int(numbers[0])
                    sizes.append(numbers[1:n + 1])
                    ids.append(numbers[n + 1:])
                elif part.as_py() == BUCKETS:
                    size, flat = np.concatenate(sizes), np.concatenate(ids)
                    if len(size) != len(numbers):
                        raise RuntimeError("a pack's words are missing")
                    start = (np.cumsum(size) - size)[numbers]
                    size = size[numbers]
                else:
                    tokens = ragged(flat, start[numbers], size[numbers])
                    ends = np.concatenate(([0], np.cumsum(np.array(n_words.as_py(), np.int64))))
                    upto = pa.array(np.concatenate(([0], np.cumsum(size[numbers])))[ends].astype(np.int32))
                    out = [docs.values, pa.ListArray.from_arrays(upto, pa.array(tokens.astype(np.int32)))]
                    if decode:
                        out.append(pc.binary_join(pa.ListArray.from_arrays(upto, pieces.take(pa.array(tokens))), " "))
                    yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][:len(out)])

    return run


def piece_table(spec: str) -> pa.Array:
    """The piece of each id."""
    cache = worker_cache().setdefault("pieces", {})
    if hash(spec) not in cache:
        content = json.loads(spec)
        of_id = {i: w for w, i in content["model"]["vocab"].items()} | {t["id"]: t["content"] for t in content["added_tokens"]}
        cache[hash(spec)] = pa.array([of_id.get(i) for i in range(max(of_id) + 1)], pa.string())
    return cache[hash(spec)]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """``doc_id, ids[, decoded]`` of every row as the tokenizers library gives them without added special tokens.

    ``path``: a BPE without a decoder in the library's JSON format, read once, by the driver; decoding then
    joins the pieces with spaces, special tokens included. A null text is an empty one (no ids, empty string).
    Rows are independent: repeated rows give repeated rows, an empty table an empty result. ``docs`` is read
    twice and must be read alike both times, as a table or a checkpoint is.
    """
    spark = prepare(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary: a fixed size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"), F.spark_partition_id().alias("_task"))
    id_type = rows.schema["doc_id"].dataType
    kind = _schema(id_type)
    lists = rows.mapInArrow(_packing(spec, True), kind).repartition("part").sortWithinPartitions("part")
    parts = lists.mapInArrow(_encoding(spec), kind).unionByName(rows.mapInArrow(_packing(spec, False), kind))
    by_pack = parts.repartition("pack").sortWithinPartitions("pack", "part")
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.StringType())] * decode)
    return by_pack.mapInArrow(_reading(spec, decode), out)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_distinct_words(spark, sf_dir: str) -> DataFrame:
    """Ids of every whole document under word_bpe_49k.json and the text they decode to, as digests."""
    import public_tokenizers
    return digests(encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
