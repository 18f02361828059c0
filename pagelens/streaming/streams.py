"""Structured Streaming jobs (re-aimed from the reference's TTL counters and caches).

Every job reads a file stream, keeps event-time state with watermarks, and
writes to a sink under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), so a lost executor or a restarted job resumes
from the checkpoint. ``run_available_now`` drains the available input
(``trigger(availableNow=True)``) and returns the sink as a batch DataFrame.

Semantics: windows and folds are final once the watermark has passed them. A
drain that is the end of its input says so with an end mark: a second stream, empty
until the input is drained, then brings one row far in the future, which moves the
watermark past everything that is still open (``Marked``). Order-dependent per-key rules
(idempotency cache, rate limit) hold a key's rows in state until the watermark has passed
them and then fold them in event order, so the order of files and batches does not
matter; rows behind the watermark are late and dropped; a key's state ends when its
counter has run out.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from pagelens.session import checkpoint_dir
from pagelens.sources.fixtures import FIXTURE_SQL
from pagelens.sources.tables import over_private, private

# The event time of an end mark: later than any event, within the range of nanosecond timestamps.
END_OF_INPUT = "2200-01-01 00:00:00"


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A given table (a file or a folder of part files) as a file stream with the batch table's schema."""
    reader = spark.readStream.schema(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a pattern that matches the table alone: a stream takes a plain path for a folder, a pattern for file or folder
    return reader.parquet(os.path.join(sf_dir, f"{name}.parque[t]"))


def stream_view(spark: SparkSession, sf_dir: str, view: str, base: str, max_files: int | None = None) -> DataFrame:
    """A derived input view over a streaming base table (same SQL as batch)."""
    stream_table(spark, sf_dir, base, max_files).createOrReplaceTempView(private(base, "stream"))
    return spark.sql(over_private(FIXTURE_SQL[view], (base,), "stream"))


def _dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    root = os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    return os.path.join(root, "out"), os.path.join(root, "checkpoint")


class Marked:
    """A stream joined by its end-mark stream; ``close`` writes the mark once the stream is drained.

    The mark row has the event time END_OF_INPUT, ``fills`` in the columns that a job
    filters or groups by, and NULL elsewhere. It never reaches a sink: its own window or
    turn only comes after END_OF_INPUT.
    """

    def __init__(self, stream: DataFrame, ts: str, **fills):
        spark = stream.sparkSession
        self.folder = os.path.join(checkpoint_dir(spark), "streams", f"marks-{uuid.uuid4().hex[:12]}")
        kinds = {f.name: f.dataType for f in stream.schema}
        values = {ts: END_OF_INPUT, **fills}
        self.mark = spark.range(1).select(*[F.lit(values.get(c)).cast(t).alias(c) for c, t in kinds.items()])
        self.mark.limit(0).write.parquet(self.folder)
        self.stream = stream.unionByName(spark.readStream.schema(self.mark.schema).parquet(self.folder))

    def close(self) -> None:
        self.mark.write.mode("append").parquet(self.folder)


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", marked: Marked | None = None) -> DataFrame:
    """Drain the stream into a parquet sink and return the sink as a batch DataFrame.

    With ``marked`` the same query then runs on over the end mark, and what was open comes out too.
    """
    spark = df.sparkSession
    out, ckpt = _dirs(spark, name)

    def drain() -> None:
        (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode(output_mode).trigger(availableNow=True).queryName(f"{name}_{uuid.uuid4().hex[:6]}").start().awaitTermination())

    drain()
    if marked is not None:
        marked.close()
        drain()
    return spark.read.schema(df.schema).parquet(out)


def run_foreach_batch(df: DataFrame, name: str, handler, read=None) -> DataFrame:
    """Drain the stream through ``handler(batch_df, batch_id, table_path)``; return the table, as ``read(spark, table_path)`` reads it if given."""
    spark = df.sparkSession
    out, ckpt = _dirs(spark, name)
    q = (df.writeStream.foreachBatch(lambda b, i: handler(b, i, out))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return read(spark, out) if read else spark.read.parquet(out)


# --- windowed aggregations ---------------------------------------------------

def failed_sessions(access: DataFrame, ip_col: str = "ip", gap: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """Per-address failure sessions (a new session after 1 h without failures)."""
    f = access.filter("failed").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    s = f.groupBy(F.session_window("ts", gap).alias("s"), ip_col).agg(F.count(F.lit(1)).alias("failures"))
    return s.select(ip_col, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    F.col("failures").cast("bigint").alias("failures"))


def _publish_measures() -> list[Column]:
    success, error = F.col("action") == "publish_success", F.col("action") == "publish_error"
    done = F.when(success, F.col("response_data"))
    return [F.count_if(success).cast("bigint").alias("total_publishes"), F.count_if(error).cast("bigint").alias("error_count"),
            F.avg("response_time_ms").alias("avg_response_time_ms"),
            F.count_if(F.contains(done, F.lit('"action":"created"'))).cast("bigint").alias("pages_created"),
            F.count_if(F.contains(done, F.lit('"action":"updated"'))).cast("bigint").alias("pages_updated")]


def _with_rate(stats: DataFrame) -> DataFrame:
    """``success_rate`` in percent with one decimal; 100 where nothing was published."""
    tried = F.col("total_publishes") + F.col("error_count")
    return stats.withColumn("success_rate", F.when(tried > 0, F.round(F.col("total_publishes") / tried * 100, 1)).otherwise(100.0))


def publish_stats(logs: DataFrame, size: str = "1 day", slide: str | None = None,
                  delay: str = "0 seconds") -> DataFrame:
    """Day (or sliding) windows of publish counts, errors, success rate, mean response time, pages created and updated."""
    lg = logs.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", delay)
    w = F.window("created_at", size, slide) if slide else F.window("created_at", size)
    a = lg.groupBy(w.alias("w")).agg(*_publish_measures())
    return _with_rate(a.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *a.columns[1:]))


def publish_stats_monthly(logs: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``publish_stats`` by calendar month: state is one row of sums a month, closed when the watermark passes the month's end.

    No window of fixed length is a month; a session window that starts with the month, with the month's length as its gap, is.
    All events of a month have the same one, so each task adds up its events to one row a month before they are shuffled.
    The watermark is that of the months' starts: it passes the end of a month with the first event of a later one that
    is ``delay`` old.
    """
    lg = logs.withColumn("window_start", F.date_trunc("month", F.col("created_at").cast("timestamp"))).withWatermark("window_start", delay)
    start = F.col("window_start")
    length = F.unix_micros(F.add_months(start, 1).cast("timestamp")) - F.unix_micros(start)
    w = F.session_window("window_start", F.concat(length.cast("string"), F.lit(" microseconds")))
    # Spark takes a session window only beside another key
    a = lg.groupBy(w.alias("w"), F.unix_micros(start).alias("_month")).agg(*_publish_measures())
    return _with_rate(a.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *a.columns[2:]))


# --- foreachBatch sinks ------------------------------------------------------

def webhook_outbox_handler(batch: DataFrame, batch_id: int, table: str) -> None:
    """Append this batch's webhook rows to the outbox table (idempotent per batch id)."""
    from pagelens.operators.logs import webhook_outbox
    out = webhook_outbox(batch).withColumn("batch_id", F.lit(batch_id))
    # Overwrite only this batch's partition: a retried batch replaces its own rows.
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(table))


def _newest(rows: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    order = F.struct(ts, *[c for c in cols if c != key])
    return rows.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("r")).select("r.*")


def latest_state_handler(key: str, ts: str):
    """Appends the newest row per key of each batch; a retried batch replaces its own rows only."""
    def handle(batch: DataFrame, batch_id: int, table: str) -> None:
        (_newest(batch, key, ts, batch.columns).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(table))
    return handle


def latest_state(table: DataFrame, key: str, ts: str) -> DataFrame:
    """The newest row per key over all batches of a ``latest_state_handler`` table (last write wins)."""
    return _newest(table, key, ts, [c for c in table.columns if c != "batch_id"])


#: Batches whose rows stand beside a generation of a compacted state before they are merged into the next one.
SEGMENTS = 8


def _generation(spark: SparkSession, table: str) -> tuple[int, int]:
    """Number of the valid generation and the last batch it holds; (0, -1) before the first."""
    try:
        rows = spark.read.schema("generation long, upto long").parquet(os.path.join(table, "manifest"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, -1
    last = rows.agg(F.max(F.struct("generation", "upto")).alias("m")).first().m
    return (last.generation, last.upto) if last else (0, -1)


def _live(spark: SparkSession, table: str, generation: int, upto: int) -> DataFrame:
    """Rows of the valid generation and of the batches after it."""
    segments = spark.read.option("recursiveFileLookup", "true").parquet(os.path.join(table, "segments")).filter(F.col("batch_id") > upto)
    if not generation:
        return segments
    return spark.read.parquet(os.path.join(table, "generations", str(generation % 2))).unionByName(segments)


def compacted_state_handler(key: str, ts: str, segments: int = SEGMENTS):
    """Newest row per key in a table whose size is bounded by its keys, however many batches come.

    Each batch leaves its newest rows in one of ``segments`` places. When all places are taken, they and the valid
    generation are merged, key by key, into the other of two generation folders, and one manifest row makes that
    one valid and its batches settled. A place or folder is only overwritten when nothing valid stands there, and rows of
    settled batches are not read, so a crash between any two steps, or a repeated batch, changes nothing. A reader
    that is still at work two generations later has to read again.
    """
    def handle(batch: DataFrame, batch_id: int, table: str) -> None:
        spark = batch.sparkSession
        generation, upto = _generation(spark, table)
        newest = _newest(batch, key, ts, batch.columns).withColumn("batch_id", F.lit(batch_id).cast("long"))
        newest.write.mode("overwrite").parquet(os.path.join(table, "segments", str(batch_id % segments)))
        if batch_id - upto >= segments:
            live = _live(spark, table, generation, upto)
            merged = _newest(live, key, ts, batch.columns).withColumn("batch_id", F.lit(batch_id).cast("long"))
            merged.write.mode("overwrite").parquet(os.path.join(table, "generations", str((generation + 1) % 2)))
            row = spark.range(1).select(F.lit(generation + 1).cast("long").alias("generation"), F.lit(batch_id).cast("long").alias("upto"))
            row.coalesce(1).write.mode("append").parquet(os.path.join(table, "manifest"))
    return handle


def compacted_state(spark: SparkSession, table: str, key: str, ts: str) -> DataFrame:
    """The newest row per key of a ``compacted_state_handler`` table."""
    return latest_state(_live(spark, table, *_generation(spark, table)), key, ts)


# --- stateful per-key folds ---------------------------------------------------

def _ttl_fold(max_requests: int, window_seconds: int, key_col: str):
    """applyInPandasWithState function: counter with TTL restarted by accepted rows.

    State: count, last accepted time, and the rows ahead of the watermark as packed (time, id)
    pairs. A call folds the rows that the watermark has passed, in event order.
    """
    window_us = int(window_seconds) * 1_000_000

    def fn(key, pdfs, state):
        count, last_ok, held = state.get if state.exists else (0, None, b"")
        parts = [np.frombuffer(held, "<i8").reshape(-1, 2)]
        for pdf in pdfs:
            t = pd.to_datetime(pdf["ts"]).to_numpy().astype("datetime64[us]").astype("int64")
            parts.append(np.column_stack([t, pdf["event_id"].to_numpy(dtype="int64")]))
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        now = state.getCurrentWatermarkMs() * 1000
        due, later = rows[rows[:, 0] < now], rows[rows[:, 0] >= now]
        accepted = np.zeros(len(due), bool)
        for i, ti in enumerate(due[:, 0].tolist()):
            if last_ok is None or ti - last_ok > window_us:
                count, last_ok, accepted[i] = 1, ti, True
            elif count < max_requests:
                count, last_ok, accepted[i] = count + 1, ti, True
        if not len(later) and (last_ok is None or last_ok + window_us < now):
            if state.exists:
                state.remove()
        else:
            state.update((int(count), last_ok, later.astype("<i8").tobytes()))
            # wake when the earliest held row is passed, or when the counter has run out
            wake = int(later[0, 0]) if len(later) else last_ok + window_us
            state.setTimeoutTimestamp(max(wake, now) // 1000 + 1)
        yield pd.DataFrame({"event_id": due[:, 1], key_col: pd.Series([key[0]] * len(due), dtype=object),
                            "ts": due[:, 0].astype("datetime64[us]"), "accepted": accepted})
    return fn


def ttl_counter(events: DataFrame, key_col: str, max_requests: int, window_seconds: int,
                delay: str = "1 hour") -> DataFrame:
    """Per-key accept/reject decisions from a stateful stream, in event order whatever the order of arrival.

    A decision comes out once the watermark (``delay`` behind the newest event) has passed
    its row; a row that arrives behind the watermark is dropped.
    """
    e = (events.select("event_id", key_col, F.col("ts").cast("timestamp").alias("ts"))
         .withWatermark("ts", delay))
    return e.groupBy(key_col).applyInPandasWithState(
        _ttl_fold(max_requests, window_seconds, key_col),
        outputStructType=f"event_id bigint, {key_col} string, ts timestamp, accepted boolean",
        stateStructType="count bigint, last_ok bigint, held binary",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)


def schedule_filter(requests: DataFrame) -> DataFrame:
    """Accept a schedule only when publish_at parses and lies after the request time.

    Adds ``publish_ts``, ``accepted`` and ``schedule_key`` = md5(slug || epoch seconds).
    """
    at = F.try_to_timestamp(F.col("publish_at"))
    ok = at.isNotNull() & (at > F.col("requested_at").cast("timestamp"))
    key = F.md5(F.concat(F.col("slug"), F.unix_timestamp(at).cast("string")))
    return requests.select("request_id", "slug", at.alias("publish_ts"), F.coalesce(ok, F.lit(False)).alias("accepted"),
                           F.when(ok, key).alias("schedule_key"))


def schedules(requests: DataFrame) -> DataFrame:
    """Accepted schedules, due or not: what the stream keeps until their time comes."""
    return schedule_filter(requests).filter("accepted").select("request_id", "slug", "publish_ts", "schedule_key")


def schedule_due(kept: DataFrame, as_of: str, after: str | None = None) -> DataFrame:
    """Kept schedules whose publish time has come at ``as_of`` (and had not at ``after``, the last release)."""
    due = kept.filter(F.col("publish_ts") <= F.to_timestamp(F.lit(as_of)))
    return due.filter(F.col("publish_ts") > F.to_timestamp(F.lit(after))) if after else due
