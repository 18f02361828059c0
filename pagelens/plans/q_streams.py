"""§2.10 queries: Structured Streaming jobs drained with ``availableNow``.

Each query starts a streaming job over the given files, waits for it to
drain, and returns its sink as a DataFrame. Oracles are the batch forms over
the whole input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import access as A
from pagelens.plans.q_access import HEADERS, IP_SQL, RATE_MAX, RATE_WINDOW
from pagelens.plans.q_logs import REDACT_SQL
from pagelens.plans.registry import query
from pagelens.streaming import streams as ST

SCHEDULE_AS_OF = "2024-03-02 12:00:00"


def _access_stream(t):
    s = ST.stream_view(t.spark, t.sf_dir, "access_log", "events")
    return s.withColumn("ip", A.client_ip(*HEADERS))


@query("stream_failed_sessions", oracle=f"""
WITH f AS (SELECT event_id, {IP_SQL} AS ip, CAST(ts AS TIMESTAMP) AS ts FROM access_log WHERE failed),
g AS (SELECT *, lag(ts) OVER (PARTITION BY ip ORDER BY ts, event_id) AS pts FROM f),
h AS (SELECT *, sum(CASE WHEN pts IS NULL OR epoch_us(ts) - epoch_us(pts) >= 3600000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY ip ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g),
s AS (SELECT ip, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end,
        CAST(count(*) AS BIGINT) AS failures FROM h GROUP BY ip, sid)
SELECT * FROM s""", views=("access_log",))
def stream_failed_sessions(t):
    """Failure sessions per address from a stream: session_window(1 h), all sessions once the input has ended."""
    m = ST.Marked(_access_stream(t), "ts", failed=True)
    return ST.run_available_now(ST.failed_sessions(m.stream), "failed_sessions", marked=m)


@query("stream_publish_stats", oracle="""
WITH d AS (SELECT date_trunc('day', created_at) AS window_start, date_trunc('day', created_at) + INTERVAL 1 DAY AS window_end,
    CAST(count(*) FILTER (WHERE action = 'publish_success') AS BIGINT) AS total_publishes,
    CAST(count(*) FILTER (WHERE action = 'publish_error') AS BIGINT) AS error_count,
    round(avg(response_time_ms), 6) AS avg_response_time_ms,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"created"')) AS BIGINT) AS pages_created,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"updated"')) AS BIGINT) AS pages_updated,
    CASE WHEN count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')) > 0 THEN
      round(100.0 * count(*) FILTER (WHERE action = 'publish_success') / count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')), 1) ELSE 100.0 END AS success_rate
  FROM publish_logs GROUP BY 1, 2)
SELECT * FROM d""", views=("publish_logs",))
def stream_publish_stats(t):
    """Daily publish counts, errors and mean response time from a stream, the last day included."""
    m = ST.Marked(ST.stream_view(t.spark, t.sf_dir, "publish_logs", "events"), "created_at")
    out = ST.run_available_now(ST.publish_stats(m.stream), "publish_stats", marked=m)
    return out.withColumn("avg_response_time_ms", F.round("avg_response_time_ms", 6))


@query("stream_publish_stats_monthly", oracle="""
WITH d AS (SELECT date_trunc('month', created_at)::TIMESTAMP AS window_start, (date_trunc('month', created_at) + INTERVAL 1 MONTH)::TIMESTAMP AS window_end,
    CAST(count(*) FILTER (WHERE action = 'publish_success') AS BIGINT) AS total_publishes,
    CAST(count(*) FILTER (WHERE action = 'publish_error') AS BIGINT) AS error_count,
    round(avg(response_time_ms), 6) AS avg_response_time_ms,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"created"')) AS BIGINT) AS pages_created,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"updated"')) AS BIGINT) AS pages_updated,
    CASE WHEN count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')) > 0 THEN
      round(100.0 * count(*) FILTER (WHERE action = 'publish_success') / count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')), 1) ELSE 100.0 END AS success_rate
  FROM publish_logs GROUP BY 1, 2)
SELECT * FROM d""", views=("publish_logs",))
def stream_publish_stats_monthly(t):
    """Publish statistics by calendar month from a stream, the last month included."""
    m = ST.Marked(ST.stream_view(t.spark, t.sf_dir, "publish_logs", "events"), "created_at")
    out = ST.run_available_now(ST.publish_stats_monthly(m.stream), "publish_stats_month", marked=m)
    return out.withColumn("avg_response_time_ms", F.round("avg_response_time_ms", 6))


@query("stream_publish_stats_weekly", oracle="""
WITH b AS (SELECT created_at, action, response_time_ms, response_data FROM publish_logs),
w AS (SELECT TIMESTAMP '1970-01-01' + INTERVAL 1 DAY * (CAST(floor(epoch(created_at) / 86400) AS BIGINT) - k) AS window_start,
        action, response_time_ms, response_data, created_at
      FROM b, range(0, 7) r(k)),
d AS (SELECT window_start, window_start + INTERVAL 7 DAY AS window_end,
    CAST(count(*) FILTER (WHERE action = 'publish_success') AS BIGINT) AS total_publishes,
    CAST(count(*) FILTER (WHERE action = 'publish_error') AS BIGINT) AS error_count,
    round(avg(response_time_ms), 6) AS avg_response_time_ms,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"created"')) AS BIGINT) AS pages_created,
    CAST(count(*) FILTER (WHERE action = 'publish_success' AND contains(response_data, '"action":"updated"')) AS BIGINT) AS pages_updated,
    CASE WHEN count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')) > 0 THEN
      round(100.0 * count(*) FILTER (WHERE action = 'publish_success') / count(*) FILTER (WHERE action IN ('publish_success', 'publish_error')), 1) ELSE 100.0 END AS success_rate
  FROM w GROUP BY 1, 2)
SELECT * FROM d""", views=("publish_logs",))
def stream_publish_stats_weekly(t):
    """Sliding 7-day windows (1-day slide) of publish statistics from a stream, the last ones included."""
    m = ST.Marked(ST.stream_view(t.spark, t.sf_dir, "publish_logs", "events"), "created_at")
    out = ST.run_available_now(ST.publish_stats(m.stream, "7 days", "1 day"), "publish_stats_week", marked=m)
    return out.withColumn("avg_response_time_ms", F.round("avg_response_time_ms", 6))


@query("stream_webhook_outbox", oracle=f"""
SELECT id, 'echo5_publish_' || action AS event, status, correlation_id, created_at AS timestamp,
  {REDACT_SQL.format(x='request_data')} AS data
FROM publish_logs WHERE status = 'error' OR action IN ('publish_success', 'publish_failed', 'rollback_success')
""", views=("publish_logs",))
def stream_webhook_outbox(t):
    """Webhook outbox written per micro-batch by foreachBatch (retries replace their batch)."""
    logs = ST.stream_view(t.spark, t.sf_dir, "publish_logs", "events")
    return ST.run_foreach_batch(logs, "webhook_outbox", ST.webhook_outbox_handler).drop("batch_id")


@query("stream_latest_page_state", oracle="""
SELECT slug, arg_max(request_id, requested_at) AS request_id, max(requested_at) AS requested_at
FROM publish_requests GROUP BY slug""", views=("publish_requests",))
def stream_latest_page_state(t):
    """Newest publish request per slug: the newest of each micro-batch, merged into generations of one row per slug."""
    reqs = ST.stream_view(t.spark, t.sf_dir, "publish_requests", "documents").select(
        "slug", "request_id", F.col("requested_at").cast("timestamp").alias("requested_at"))
    return ST.run_foreach_batch(reqs, "latest_page_state", ST.compacted_state_handler("slug", "requested_at"),
                                lambda spark, table: ST.compacted_state(spark, table, "slug", "requested_at"))


def _fold_sql(key_sql: str, max_n: int, window_s: int, key_name: str) -> str:
    return f"""
WITH RECURSIVE r AS (
  SELECT event_id, {key_sql} AS k, CAST(ts AS TIMESTAMP) AS ts,
    row_number() OVER (PARTITION BY {key_sql} ORDER BY ts, event_id) AS rn FROM access_log),
f(k, rn, event_id, ts, cnt, last_ok, accepted) AS (
  SELECT k, rn, event_id, ts, 1, epoch_us(ts), true FROM r WHERE rn = 1
  UNION ALL
  SELECT r.k, r.rn, r.event_id, r.ts,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {window_s}000000 THEN 1 WHEN f.cnt >= {max_n} THEN f.cnt ELSE f.cnt + 1 END,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {window_s}000000 THEN epoch_us(r.ts) WHEN f.cnt >= {max_n} THEN f.last_ok
         ELSE epoch_us(r.ts) END,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {window_s}000000 THEN true WHEN f.cnt >= {max_n} THEN false ELSE true END
  FROM f JOIN r ON r.k = f.k AND r.rn = f.rn + 1)
SELECT event_id, k AS {key_name}, ts, accepted FROM f"""


@query("stream_idempotent_requests", oracle=_fold_sql("idempotency_key", 1, 3600, "idempotency_key"),
       views=("access_log",))
def stream_idempotent_requests(t):
    """Idempotency cache as stream state: a key is processed again only 1 h after its kept result."""
    m = ST.Marked(ST.stream_view(t.spark, t.sf_dir, "access_log", "events"), "ts", event_id=-1)
    return ST.run_available_now(ST.ttl_counter(m.stream, "idempotency_key", 1, 3600), "idempotency", marked=m)


@query("stream_rate_limit", oracle=_fold_sql(IP_SQL, RATE_MAX, RATE_WINDOW, "ip"), views=("access_log",))
def stream_rate_limit(t):
    """Rate limit as per-address stream state (count, last accepted); max 3 per 6 h."""
    m = ST.Marked(_access_stream(t), "ts", event_id=-1)
    return ST.run_available_now(ST.ttl_counter(m.stream, "ip", RATE_MAX, RATE_WINDOW), "rate_limit", marked=m)


@query("schedule_filter", oracle="""
SELECT request_id, coalesce(TRY_CAST(publish_at AS TIMESTAMP) > requested_at, false) AS accepted,
  CASE WHEN TRY_CAST(publish_at AS TIMESTAMP) > requested_at
       THEN md5(slug || CAST(CAST(epoch(TRY_CAST(publish_at AS TIMESTAMP)) AS BIGINT) AS VARCHAR)) END AS schedule_key
FROM schedule_requests""", views=("schedule_requests",))
def schedule_filter(t):
    """Accept schedules whose publish time parses and is after the request time; md5 key."""
    return ST.schedule_filter(t.schedule_requests).select("request_id", "accepted", "schedule_key")


@query("stream_schedule_due", oracle=f"""
SELECT request_id, slug, TRY_CAST(publish_at AS TIMESTAMP) AS publish_ts,
  md5(slug || CAST(CAST(epoch(TRY_CAST(publish_at AS TIMESTAMP)) AS BIGINT) AS VARCHAR)) AS schedule_key
FROM schedule_requests WHERE TRY_CAST(publish_at AS TIMESTAMP) > requested_at
  AND TRY_CAST(publish_at AS TIMESTAMP) <= TIMESTAMP '{SCHEDULE_AS_OF}'""", views=("schedule_requests",))
def stream_schedule_due(t):
    """Accepted schedules kept by a stream, released when due at the release time."""
    s = ST.stream_view(t.spark, t.sf_dir, "schedule_requests", "documents")
    return ST.schedule_due(ST.run_available_now(ST.schedules(s), "schedules"), SCHEDULE_AS_OF)
