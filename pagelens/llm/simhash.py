"""SimHash near-duplicates with pivot distance tables.

Every fingerprint gets a table of its Hamming distances to many fixed reference
fingerprints. By the triangle inequality two fingerprints within MAX_BITS differ by
at most MAX_BITS in every column; a pair over that in some column is discarded, the
survivors are verified bit by bit.

A pivot table prunes pairs but does not form them: on near-uniform fingerprints one
column lets over half of all pairs through. Pairs are therefore only formed inside
cells: of BLOCKS bit blocks, two fingerprints within MAX_BITS agree on
BLOCKS - MAX_BITS at least, so that each linked pair meets in the cell of some such
choice of blocks. No link is lost. Equal fingerprints are one entry throughout.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import free, prepare, row_key, table
from pagelens.llm.components import components

#: Words of a shingle and largest distance of a link.
SHINGLE, MAX_BITS = 4, 4
#: Bit blocks a fingerprint is cut into; cells fix BLOCKS - MAX_BITS of them.
BLOCKS = 7
#: Reference fingerprints of the pivot table.
PIVOTS = np.random.default_rng(20_240_117).integers(0, 1 << 64, 32, dtype=np.uint64)
#: Fingerprints of a cell that are compared in one go; larger cells are cut into such chunks, dealt out in pairs.
CHUNK = 4096
#: Groups of up to so many fingerprints are compared pair by pair.
SMALL = 8


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles (XXH64, seed 42); 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and white space as in [\\x20\\x09-\\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, _key, fp`` (the row's key and its fingerprint as a signed long) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "_key", "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema[:2], T.StructField("fp", T.LongType())]))


def cell_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """For each choice of blocks - max_bits blocks the mask of their bits, as a signed long."""
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(block, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def near(a: np.ndarray, b: np.ndarray, pivots_a: np.ndarray, pivots_b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs (a, b) are links: by the pivot table first, then the survivors bit by bit."""
    out = np.abs(pivots_a - pivots_b).max(axis=-1) <= max_bits
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count((a if np.ndim(a) == 0 else a[at]) ^ b[at]) <= max_bits
    return out


def cell_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a cell's links: each fingerprint is held against those not reached yet."""
    pivots, todo, a, b = pivot_table(fps), np.arange(len(fps)), [], []
    while len(todo):
        queue, todo = [todo[0]], todo[1:]
        while queue and len(todo):
            i = queue.pop()
            hit = near(fps[i], fps[todo], pivots[i], pivots[todo], max_bits)
            reached, todo = todo[hit], todo[~hit]
            queue += reached.tolist()
            a.append(np.full(len(reached), i))
            b.append(reached)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def group_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of all groups; ``group`` numbers the fingerprints' groups, which lie together."""
    edge = np.flatnonzero(np.diff(group)) + 1
    start, size = np.concatenate(([0], edge)), np.diff(np.concatenate(([0], edge, [len(group)])))
    u, v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    small = np.repeat(size, size) <= SMALL
    for d in range(1, min(SMALL, len(group))):  # small groups: all their pairs at once
        i = np.flatnonzero(small[:-d] & (group[:-d] == group[d:]))
        if len(i):
            hit = i[near(fps[i], fps[i + d], pivot_table(fps[i]), pivot_table(fps[i + d]), max_bits)]
            u.append(fps[hit])
            v.append(fps[hit + d])
    for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        cell = np.unique(fps[s:s + n])
        i, j = cell_links(cell, max_bits)
        u.append(cell[i])
        v.append(cell[j])
    return np.concatenate(u).view(np.int64), np.concatenate(v).view(np.int64)


def _links_of(max_bits: int):
    def run(batches):
        group, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for b in batches:  # sorted by group; the last group of a batch may go on in the next
            group = np.concatenate((group, b.column(0).to_numpy()))
            fps = np.concatenate((fps, b.column(1).to_numpy().view(np.uint64)))
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if cut:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in group_links(group[:cut], fps[:cut], max_bits)], names=["u", "v"])
                group, fps = group[cut:], fps[cut:]
        if len(group):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in group_links(group, fps, max_bits)], names=["u", "v"])

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """(u, v) fingerprints of links that join what any link joins; ``fps`` holds each fingerprint once, as ``fp``."""
    masks = cell_masks(max_bits, blocks)
    cells = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("_c", "_bits"))
    cells = cells.select("fp", F.xxhash64("_c", "_bits").alias("_cell"))
    sized = cells.selectExpr("fp", "_cell", "row_number() OVER (PARTITION BY _cell ORDER BY fp) AS _r", "count(1) OVER (PARTITION BY _cell) AS _n")
    sized = sized.filter("_n > 1").selectExpr("fp", "_cell", f"(_r - 1) div {CHUNK} AS _own", f"(_n - 1) div {CHUNK} AS _last")
    # a chunk meets itself only where the cell has no other; else the pairs of chunks cover it
    dealt = sized.select("fp", "_cell", "_own", "_last", F.explode(F.expr("sequence(0L, _last)")).alias("_other"))
    dealt = dealt.filter("_last = 0 OR _own != _other")
    dealt = dealt.select(F.xxhash64("_cell", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("_group"), "fp")
    dealt = dealt.repartition("_group").sortWithinPartitions("_group")
    return dealt.mapInArrow(_links_of(max_bits), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, _key, fp, _root, component_id`` of every row; component_id is the smallest id that links reach.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. A null
    id never is a component's id unless the component has no other. Equal rows stay equal rows.
    An empty table gives an empty result. ``_root`` is the component's least fingerprint.
    """
    prepare(docs.sparkSession)
    rows = fingerprints(docs, id_col, text_col, shingle).checkpoint()
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    roots = components(links(firsts.select("fp"), max_bits))
    rooted = firsts.join(roots, firsts["fp"] == roots["node"], "left").select("fp", "_first", F.coalesce("root", "fp").alias("_root"))
    least = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    of_fp = rooted.join(least, "_root").select(F.col("fp").alias("_fp"), "_root", "component_id")
    return rows.join(of_fp, rows["fp"] == of_fp["_fp"]).select("doc_id", "_key", "fp", "_root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with all columns of ``docs``, whatever these are called: that of the smallest id (null ids last).

    Null, empty and blank texts are one component. Of equal rows one stays. An empty table gives an empty result.
    """
    key, kept_key = free(docs, "key", "kept")
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("_key").alias("k"))
    kept = found.groupBy("_root").agg(F.min(rank).alias("_first")).select(F.struct(F.col("_first.k").alias("k"), F.col("_first.i").alias("i")).alias(kept_key))
    # one key of hash and id; structs with null ids are equal
    keyed = docs.withColumn(key, F.struct(row_key(id_col, text_col).alias("k"), F.col(id_col).alias("i")))
    return keyed.join(kept, F.col(key) == F.col(kept_key), "left_semi").dropDuplicates([key]).select(*docs.columns)


def op6_simhash_pivots(spark, sf_dir: str) -> DataFrame:
    """SimHash of 4-word shingles of whole documents, linked at 4 differing bits or fewer."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
