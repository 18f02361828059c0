"""Exact top-k search by selection on distributed score histograms.

The rows are packed once into blocks of bounded size, and the queries among them into
blocks of their own. Every pair of a part of the candidates and a part of the queries is
one task: it reads both from where they are kept, so the grid of pairs is never written
down, joined by a key or sent to the driver. Every score is computed, none is stored. In each
round a task counts its scores per query in bins of the range that still holds the kth score;
the counts are summed over all tasks, the bin of the kth score becomes the next range, until it is
one score wide. A last round emits the scores above that value and, of the scores equal to it, the smallest ids.

A task only reports its highest bins, down to its own kth score: the global kth
score is no lower, so no bin below can matter, and no score below what it has counted already need be looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelens.llm.common import prepare, table

#: Most queries and candidates of a block, and log2 of the bins of a histogram.
QUERY_BLOCK, ROW_BLOCK, BIN_BITS = 4096, 4096, 8
#: Most components of a block of more than one row, and scores computed at once.
BLOCK_COMPONENTS, TILE = 1 << 22, 1 << 20
#: Parts of the candidates: a round's counts grow with the queries times this.
PARTS = 16
#: A query's key is the number of its block and, in so many bits, its place there.
_PLACE_BITS = 24
#: Sums of products below these are exact in floats and doubles.
_EXACT = ((np.float32, float(1 << 24)), (np.float64, float(1 << 53)))

_BLOCK = "_block long, _n int, _queries int, _norm double, _bytes int, _ids binary, _vids binary, _asked binary, _data binary"


def _vectors(rows: DataFrame, is_query, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``_id, _vid, _asked, _v``: a number of the row's own, its id, whether it is a query, components floored after scaling; rows without a usable vector are left out.

    The numbers are unique, but another reading may give others: they are to be written down (a checkpoint) before use.
    """
    v = F.col(vec_col)
    usable = rows.filter(F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    floored = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    numbered = usable.select(F.monotonically_increasing_id().alias("_id"), F.col(id_col).alias("_vid"), floored.alias("_v"))
    return numbered.select("_id", "_vid", F.coalesce(is_query(F.col("_vid")), F.lit(False)).alias("_asked"), "_v")


def _runs(batches, size: int):
    """Lists of successive batches with at most ``size`` rows and, zero-padded, ``BLOCK_COMPONENTS`` components (or one row) together."""
    run, rows, widest = [], 0, 1
    for b in batches:
        wide = max(1, pc.max(pc.list_value_length(b.column("_v"))).as_py() or 0)
        while b.num_rows:
            room = min(size, BLOCK_COMPONENTS // max(widest, wide)) - rows
            if run and room < 1:
                yield run
                run, rows, widest = [], 0, 1
                continue
            part = b.slice(0, max(1, room))
            run.append(part)
            rows, widest, b = rows + part.num_rows, max(widest, wide), b.slice(part.num_rows)
    if run:
        yield run


def _pack(size: int):
    """Rows to blocks of about ``size`` rows, by ascending id; components are zero-padded to the block's width and kept in as few bytes as hold them."""
    def run(batches):
        block = TaskContext.get().partitionId() << 20
        for i, rows in enumerate(_runs(batches, size)):
            t = pa.Table.from_batches(rows).combine_chunks()
            ids, vids, asked = (t.column(c).to_numpy().astype(kind) for c, kind in (("_id", np.int64), ("_vid", np.int64), ("_asked", bool)))
            lists = t.column("_v").combine_chunks()
            width = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            data = np.zeros((len(ids), max(1, width.max())), np.int64)
            data[np.arange(data.shape[1]) < width[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            order = np.lexsort((ids, vids))
            norm = float((data.astype(float) ** 2).sum(axis=1).max())
            kind = next(x for x in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(x).min <= data.min() and data.max() <= np.iinfo(x).max)
            yield pa.RecordBatch.from_arrays([
                pa.array([block | i], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([int(asked.sum())], pa.int32()), pa.array([norm]),
                pa.array([np.dtype(kind).itemsize], pa.int32()),
                *(pa.array([x.tobytes()], pa.binary()) for x in (ids[order], vids[order], asked[order], data.astype(kind)[order]))],
                names=["_block", "_n", "_queries", "_norm", "_bytes", "_ids", "_vids", "_asked", "_data"])
    return run


def _read(b, r: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, ids and components of the block in a row of a batch."""
    ids, vids = (np.frombuffer(b.column(prefix + c)[r].as_buffer(), np.int64) for c in ("_ids", "_vids"))
    data = np.frombuffer(b.column(prefix + "_data")[r].as_buffer(), f"i{b.column(prefix + '_bytes')[r].as_py()}")
    return ids, vids, data.reshape(len(ids), -1)


def _asked(batches):
    """The queries of blocks, as rows."""
    for b in batches:
        for r in range(b.num_rows):
            ids, vids, data = _read(b, r)
            asked = np.frombuffer(b.column("_asked")[r].as_buffer(), bool)
            data = data[asked].astype(np.int64)
            ends = np.arange(len(data) + 1, dtype=np.int32) * data.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(ids[asked]), pa.array(vids[asked]), pa.array(asked[asked]), pa.ListArray.from_arrays(
                pa.array(ends), pa.array(data.ravel()))], names=["_id", "_vid", "_asked", "_v"])


class _Scores:
    """The queries of a block, with the range of their kth scores, beside one block of candidates after the other."""

    def __init__(self, b, r: int, lowest: int, k: int):
        self.ids, self.vids, self.data = _read(b, r, "_q")
        self.keys = b.column("_block")[r].as_py() << _PLACE_BITS | np.arange(len(self.ids))
        if b.column("_places")[r].is_valid:
            at = b.column("_places")[r].values.to_numpy()
            self.ids, self.vids, self.data, self.keys = (x[at] for x in (self.ids, self.vids, self.data, self.keys))
            self.lo, self.need = (b.column(c)[r].values.to_numpy() for c in ("_lo", "_need"))
        else:
            self.lo, self.need = (np.full(len(self.ids), x, np.int64) for x in (lowest, k))
        self.most = float(max(self.data.max(initial=0), -int(self.data.min(initial=0))))
        self.least, self.seen, self.kept = self.lo.copy(), 0, {}

    def _as(self, kind):
        if kind not in self.kept:
            self.kept[kind] = self.data.astype(kind)
        return self.kept[kind]

    def tiles(self, data: np.ndarray):
        """``rows, at, to, score``: a slice of the queries; numbers of query and candidate and score of its pairs that reach ``least``, by query, then candidate.

        Scores are 64-bit integers; sums beyond 64 bits wrap. The first candidates come in few at a time, as nothing is known of the kth score yet.
        """
        width = min(self.data.shape[1], data.shape[1])
        top = self.most * float(max(data.max(initial=0), -int(data.min(initial=0)))) * width
        kind = next((x for x, exact in _EXACT if top < exact), np.int64)
        q, c, first = self._as(kind)[:, :width], data.astype(kind)[:, :width], 0
        while first < len(c):
            last = min(len(c), first + max(256, 2 * self.seen))
            step = max(1, TILE // (last - first))
            for i in range(0, len(q), step):
                rows = slice(i, i + step)
                score = q[rows] @ c[first:last].T
                hit = np.flatnonzero(score >= self.least[rows, None].astype(kind))
                at, to = np.divmod(hit, last - first)
                yield rows, at, to + first, score.ravel()[hit].astype(np.int64)
            self.seen += last - first
            first = last


def _each(batches, lowest: int, k: int, kept: dict):
    """Each block of candidates (numbers, ids, components) with the scores of the block of queries beside it."""
    for b in batches:
        for r in range(b.num_rows):
            block = b.column("_block")[r].as_py()
            if block not in kept:
                kept[block] = _Scores(b, r, lowest, k)
            yield kept[block], _read(b, r)


def _histogram(span: int, shift: int, lowest: int, k: int):
    """``_q, _need, _from, _n``: how many scores of a query are in the bin that begins at a score."""
    bins = 1 << BIN_BITS

    def run(batches):
        kept, counts = {}, {}
        for s, (ids, _, data) in _each(batches, lowest, k, kept):
            n = counts.setdefault(id(s), np.zeros((len(s.ids), bins), np.int64))
            for rows, at, to, score in s.tiles(data):
                # bins of the range [lo, lo + 2**span); scores above it are counted already, those below can't be wanted
                bin_ = (score - s.lo[rows][at]).view(np.uint64) >> np.uint64(shift)
                inside = (bin_ < np.uint64(1 << (span - shift))) & (s.ids[rows][at] != ids[to])
                if not inside.any():
                    continue
                mine = n[rows]
                mine += np.bincount(at[inside] << BIN_BITS | bin_[inside].astype(np.int64), minlength=mine.size).reshape(mine.shape)
                reached = mine[:, ::-1].cumsum(axis=1) >= s.need[rows, None]
                kth = np.where(reached[:, -1], bins - 1 - reached.argmax(axis=1), 0)
                s.least[rows] = s.lo[rows] + (kth << shift)
        for s in kept.values():
            n = counts[id(s)]
            above = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
            at, bin_ = np.nonzero((n > 0) & (above < s.need[:, None]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s.keys[at], s.need[at], s.lo[at] + (bin_ << shift), n[at, bin_])],
                                             names=["_q", "_need", "_from", "_n"])
    return run


def _first(at: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of entries in order of ``at``, which are among the first ``most`` of their own."""
    start = np.flatnonzero(np.diff(at, prepend=-1))
    return np.arange(len(at)) - np.repeat(start, np.diff(start, append=len(at))) < most[at]


def _winners(lowest: int, k: int):
    """Scores above the kth one and, of those equal to it, the missing ones with the smallest ids."""
    def out(s, at, vids, score):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (s.keys[at], s.vids[at], vids, score)], names=["_q", "query_id", "vec_id", "score"])

    def least(s, ties):
        at, vids = (np.concatenate(x) for x in zip(*ties))
        order = np.lexsort((vids, at))
        at, vids = at[order], vids[order]
        mine = _first(at, s.need)
        return at[mine], vids[mine]

    def run(batches):
        kept, ties, held = {}, {}, {}
        for s, (ids, vids, data) in _each(batches, lowest, k, kept):
            mine = ties.setdefault(id(s), [])
            for rows, at, to, score in s.tiles(data):
                other = s.ids[rows][at] != ids[to]
                at, to, score = at[other] + rows.start, to[other], score[other]
                above = score > s.lo[at]
                if above.any():
                    yield out(s, at[above], vids[to[above]], score[above])
                # ids ascend in a block, so the first ties are those with the smallest ids
                at, to = at[~above], to[~above]
                first = _first(at, s.need)
                mine.append((at[first], vids[to[first]]))
                held[id(s)] = held.get(id(s), 0) + int(first.sum())
                if held[id(s)] > 2 * TILE:
                    mine[:] = [least(s, mine)]
                    held[id(s)] = 0
        for s in kept.values():
            if ties[id(s)]:
                at, vids = least(s, ties[id(s)])
                yield out(s, at, vids, s.lo[at])
    return run


def top_k(rows: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``is_query`` holds (of its id), its k best other rows by inner product.

    Ties go to the smaller id; with fewer than k other rows all are returned. Rows
    with a null id or a vector that is null or holds a null, NaN or infinite component take no
    part. Rows of one id, equal or not, are rows of their own: each is a candidate of the others, and each asks for itself. Shorter
    vectors are padded with zeros; scores are 64-bit, larger ones wrap. An empty table, or one without queries, gives an empty result.
    """
    prepare(rows.sparkSession)
    blocks = _vectors(rows, is_query, id_col, vec_col, scale).mapInArrow(_pack(ROW_BLOCK), _BLOCK).repartition(PARTS).checkpoint()
    n_queries, norm = blocks.agg(F.sum("_queries"), F.max("_norm")).first()
    n_parts = max(1, -(-(n_queries or 0) // QUERY_BLOCK))
    asked = blocks.filter("_queries > 0").mapInArrow(_asked, "_id long, _vid long, _asked boolean, _v array<long>")
    asked = asked.repartition(n_parts).mapInArrow(_pack(QUERY_BLOCK), _BLOCK).select(
        "_block", *(F.col(c).alias("_q" + c) for c in ("_bytes", "_ids", "_vids", "_data"))).checkpoint()
    # no score is outside [-reach, reach]
    reach = int((norm or 0) * (1 + 2.0 ** -40)) + 2
    bits = min(64, (2 * reach + 1).bit_length())
    lowest = -reach if bits < 64 else -(1 << 63)
    queries = asked.select("*", *(F.lit(None).cast(f"array<{t}>").alias(c) for c, t in (("_places", "int"), ("_lo", "long"), ("_need", "long"))))

    def cells(run, schema: str) -> DataFrame:
        # each part of the candidates beside each part of the queries, read in place: no side is broadcast, whatever Spark takes its size for
        candidates = blocks.select("_bytes", "_ids", "_vids", "_data")
        return candidates.crossJoin(queries.hint("shuffle_replicate_nl")).mapInArrow(run, schema)

    shift = bits
    while shift > 0:
        span, shift = shift, max(0, shift - BIN_BITS)
        seen = cells(_histogram(span, shift, lowest, k), "_q long, _need long, _from long, _n long").repartition("_q")
        seen = seen.groupBy("_q", "_need", "_from").agg(F.sum("_n").alias("_n"))
        # the first bin from the top with which k scores are reached; the lowest one if there are fewer
        above = Window.partitionBy("_q").orderBy(F.desc("_from")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = seen.withColumn("_upto", F.sum("_n").over(above)).groupBy("_q", "_need").agg(
            F.max(F.when(F.col("_upto") >= F.col("_need"), F.struct("_from", (F.col("_upto") - F.col("_n")).alias("_before")))).alias("_at"),
            F.min("_from").alias("_least"), F.sum("_n").alias("_all"), F.min_by("_n", "_from").alias("_last"))
        before = F.coalesce(F.col("_at._before"), F.col("_all") - F.col("_last"))
        place = F.col("_q").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
        state = hit.groupBy(F.shiftright("_q", _PLACE_BITS).alias("_block")).agg(F.array_sort(F.collect_list(F.struct(
            place.alias("_place"), F.coalesce("_at._from", "_least").alias("_lo"), (F.col("_need") - before).alias("_need")))).alias("_s"))
        state = state.select("_block", F.col("_s._place").alias("_places"), F.col("_s._lo").alias("_lo"), F.col("_s._need").alias("_need"))
        queries = asked.join(state.hint("merge"), "_block").repartitionByRange(n_parts, "_block").checkpoint()
    found = cells(_winners(lowest, k), "_q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_histogram_selection(spark, sf_dir: str) -> DataFrame:
    """The 20 best candidates of every vector whose id is divisible by 20, by integer inner product."""
    return top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, 20)


OP3_SQL = """
WITH v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
