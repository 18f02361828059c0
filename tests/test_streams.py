"""Streams over tables of part files equal their batch forms; folds do not depend on the order of files."""

import os
import tempfile

import pytest
from conftest import SMALL
from pagelens.streaming import streams as ST
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def parts(spark):
    """The small tables with events and documents stored as folders of three part files."""
    root = tempfile.mkdtemp(prefix="parts-", dir="/tmp")
    for f in os.listdir(SMALL):
        if f in ("events.parquet", "documents.parquet"):
            spark.read.parquet(f"{SMALL}/{f}").repartition(3).write.parquet(f"{root}/{f}")
        else:
            os.symlink(f"{SMALL}/{f}", f"{root}/{f}")
    return root


@pytest.mark.parametrize("key", ["stream_failed_sessions", "stream_publish_stats", "stream_webhook_outbox",
                                 "stream_latest_page_state", "stream_idempotent_requests", "stream_rate_limit", "stream_schedule_due"])
def test_part_files_give_the_rows_of_one_file(spark, registry, parts, key):
    from oracle import duck_conn, duck_rows, normalize, spark_rows
    got = normalize(*spark_rows(registry[key](spark, parts)))
    assert got[1] and got == normalize(*duck_rows(duck_conn(SMALL), registry[key].oracle))


def _files(spark, *batches):
    """A streamed table of one file per batch, read in this order."""
    root = tempfile.mkdtemp(prefix="events-", dir="/tmp")
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(e, k, t) for e, k, t in rows], "event_id long, k string, ts string")
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(f"{root}/events.parquet")
        for f in os.listdir(f"{root}/events.parquet"):
            path = f"{root}/events.parquet/{f}"
            if os.path.getmtime(path) > 1_000_000:
                os.utime(path, (1000 + i, 1000 + i))
    return ST.stream_table(spark, root, "events", max_files=1)


def test_fold_over_two_micro_batches_in_event_order(spark):
    first = [(1, "a", "2024-01-01 14:00:00")]
    second = [(2, "a", "2024-01-01 13:30:00"), (3, "a", "2024-01-01 13:31:00"), (4, "b", "2024-01-01 13:45:00")]
    m = ST.Marked(_files(spark, first, second), "ts", event_id=-1)
    out = ST.run_available_now(ST.ttl_counter(m.stream, "k", 1, 600, delay="1 hour"), "fold", marked=m)
    assert sorted((r.event_id, r.accepted) for r in out.collect()) == [(1, True), (2, True), (3, False), (4, True)]


def test_rows_behind_the_watermark_are_late_and_dropped(spark):
    m = ST.Marked(_files(spark, [(1, "a", "2024-01-01 14:00:00")], [(2, "a", "2024-01-01 20:00:00")], [(3, "a", "2024-01-01 12:00:00")]),
                  "ts", event_id=-1)
    out = ST.run_available_now(ST.ttl_counter(m.stream, "k", 5, 600, delay="1 hour"), "late", marked=m)
    assert sorted(r.event_id for r in out.collect()) == [1, 2]


def test_schedules_wait_for_their_time(spark):
    rows = [(1, "s", "2024-01-02 00:00:00", "2024-01-01 00:00:00"), (2, "t", "2024-02-02 00:00:00", "2024-01-01 00:00:00"),
            (3, "u", "2023-01-01 00:00:00", "2024-01-01 00:00:00")]
    kept = ST.schedules(spark.createDataFrame(rows, "request_id long, slug string, publish_at string, requested_at string"))
    due = lambda *a: sorted(r.request_id for r in ST.schedule_due(kept, *a).collect())
    assert due("2024-01-15 00:00:00") == [1]
    assert due("2024-03-01 00:00:00", "2024-01-15 00:00:00") == [2]


def test_newest_row_wins_over_batches(spark):
    table = spark.createDataFrame([("a", 1, "2024-01-01", 0), ("a", 2, "2024-01-03", 1), ("a", 3, "2024-01-02", 2)],
                                  "slug string, request_id int, at string, batch_id int")
    assert [r.request_id for r in ST.latest_state(table, "slug", "at").collect()] == [2]


def test_months_close_at_their_calendar_end(spark, tmp_path):
    times = ["2024-01-01 00:00:00", "2024-01-31 23:59:59.999999", "2024-02-01 00:00:00", "2024-02-29 12:00:00", "2024-03-31 23:59:59.999999", "2024-04-01 00:00:00", "2023-12-31 23:59:59.999999"]
    rows = [(t, "publish_success" if i % 2 else "publish_error", i, '{"action":"created"}' if i % 3 else '{"action":"updated"}') for i, t in enumerate(times)]
    logs = spark.createDataFrame(rows, "created_at string, action string, response_time_ms int, response_data string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    logs.repartition(4).write.parquet(f"{tmp_path}/logs")
    m = ST.Marked(spark.readStream.schema(logs.schema).parquet(f"{tmp_path}/logs"), "created_at")
    got = {str(r.window_start)[:10]: r for r in ST.run_available_now(ST.publish_stats_monthly(m.stream), "months", marked=m).collect()}
    assert {k: (str(r.window_end)[:10], r.total_publishes, r.error_count, r.success_rate, r.pages_created, r.pages_updated) for k, r in got.items()} == {
        "2023-12-01": ("2024-01-01", 0, 1, 0.0, 0, 0), "2024-01-01": ("2024-02-01", 1, 1, 50.0, 1, 0), "2024-02-01": ("2024-03-01", 1, 1, 50.0, 0, 1),
        "2024-03-01": ("2024-04-01", 0, 1, 0.0, 0, 0), "2024-04-01": ("2024-05-01", 1, 0, 100.0, 1, 0)}


def _files_under(path):
    return [os.path.join(d, f) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")]


def test_compacted_state_is_bounded_and_survives_crashes(spark, tmp_path, monkeypatch):
    table, handle = f"{tmp_path}/state", ST.compacted_state_handler("slug", "at", segments=3)
    schema, newest = "slug string, request_id long, at long", {}

    def bring(n, rows):
        for slug, request, at in rows:
            newest[slug] = max(newest.get(slug, (-1, -1)), (at, request))
        handle(spark.createDataFrame(rows, schema), n, table)

    def state():
        return {r.slug: (r["at"], r.request_id) for r in ST.compacted_state(spark, table, "slug", "at").collect()}

    generation = ST._generation
    stored = []
    for n in range(11):
        rows = [(f"s{k}", 100 * n + k, (7 * n + 5 * k) % 23) for k in range(n % 4, 6)] if n != 4 else []
        if n in (2, 5, 8):  # killed before the merge, then after the new generation is written but before it is valid
            monkeypatch.setattr(ST, "_live", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                bring(n, rows)
            monkeypatch.undo()
            before = generation(spark, table)
            with monkeypatch.context() as m:
                armed, join, live = [], os.path.join, ST._live
                m.setattr(ST, "_live", lambda *a: (live(*a), armed.append(1))[0])
                m.setattr(ST.os.path, "join", lambda *a: 1 / 0 if armed and a[-1] == "manifest" else join(*a))
                with pytest.raises(ZeroDivisionError):
                    bring(n, rows)
            assert generation(spark, table) == before and state() == newest
        bring(n, rows)
        assert state() == newest
        bring(n, rows)  # a repeated batch
        assert state() == newest
        kept = sum(spark.read.parquet(f).count() for f in _files_under(f"{table}/segments") + _files_under(f"{table}/generations"))
        stored.append(kept)
    assert generation(spark, table) == (3, 8)
    assert max(stored) <= (2 + 3) * len(newest)


def test_a_months_events_are_added_up_before_the_shuffle(spark):
    """The aggregate of each task, before all tasks' rows of a month meet in one, gives a row a month, not a row an event."""
    logs = spark.range(0, 20000, 1, 1).select((F.lit(1704067200) + F.col("id") * 200).cast("timestamp").alias("created_at"), F.lit("publish_error").alias("action"),
                                              F.lit(1).alias("response_time_ms"), F.lit(None).cast("string").alias("response_data"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stats = ST.publish_stats_monthly(logs)
        assert sorted(r.error_count for r in stats.collect()) == [20000 - 31 * 432, 31 * 432]
        plans = [stats._jdf.queryExecution().executedPlan()]
        for p in plans:
            plans += [p.children().apply(i) for i in range(p.children().size())]
        rows = [p.metrics().apply("numOutputRows").value() for p in plans if p.nodeName() == "HashAggregate"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert rows == [2, 2]
