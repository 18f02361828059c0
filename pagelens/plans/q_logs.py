"""M2 queries: publish-log scans, statistics, listings, export, webhooks."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from pagelens.operators import logs as L
from pagelens.plans.registry import query

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
LOG_COLS = "id, correlation_id, action, status, page_id, page_slug, user_ip, response_time_ms, created_at"


def _cols(df):
    return df.select(*[c.strip() for c in LOG_COLS.split(",")])


@query("load_publish_logs", oracle=f"SELECT {LOG_COLS} FROM publish_logs", views=("publish_logs",))
def load_publish_logs(t):
    """Publish-log table scan (pruned to the queried columns)."""
    return _cols(t.publish_logs)


def _stats_sql():
    parts = []
    for p, cond in (("day", f"created_at >= {AS_OF} - INTERVAL 1 DAY"),
                    ("week", f"created_at >= {AS_OF} - INTERVAL 7 DAY"),
                    ("month", f"created_at >= {AS_OF} - INTERVAL 1 MONTH"),
                    ("all", "TRUE")):
        parts.append(f"""
SELECT '{p}' AS period, CAST(s AS BIGINT) AS total_publishes, CAST(s AS BIGINT) AS success_count,
  CAST(e AS BIGINT) AS error_count,
  CAST(CASE WHEN s + e > 0 THEN round(s * 100.0 / (s + e), 1) ELSE 100 END AS DOUBLE) AS success_rate,
  CAST(round(coalesce(a, 0)) AS DOUBLE) AS avg_response_time_ms, CAST(c AS BIGINT) AS pages_created,
  CAST(u AS BIGINT) AS pages_updated
FROM (SELECT
  count(*) FILTER (WHERE action = 'publish_success' AND {cond}) AS s,
  count(*) FILTER (WHERE action = 'publish_error' AND {cond}) AS e,
  avg(response_time_ms) FILTER (WHERE response_time_ms IS NOT NULL AND {cond}) AS a,
  count(*) FILTER (WHERE action = 'publish_success' AND response_data LIKE '%"action":"created"%' AND {cond}) AS c,
  count(*) FILTER (WHERE action = 'publish_success' AND response_data LIKE '%"action":"updated"%' AND {cond}) AS u
FROM publish_logs)""")
    return "\nUNION ALL".join(parts)


@query("publish_statistics", oracle=_stats_sql(), views=("publish_logs",))
def publish_statistics(t):
    """Statistics for day, week, month and all time, from one aggregation pass."""
    return L.publish_statistics(t.publish_logs)


@query("recent_errors", oracle=f"""
SELECT id, page_slug, error_message, created_at FROM publish_logs
WHERE status = 'error' AND created_at >= {AS_OF} - INTERVAL 7 DAY
ORDER BY created_at DESC, id DESC LIMIT 5
""", views=("publish_logs",))
def recent_errors(t):
    """Five newest errors of the last week."""
    return L.recent_errors(t.publish_logs, "week")


@query("period_filter", oracle=f"""
SELECT id, created_at FROM publish_logs WHERE created_at >= {AS_OF} - INTERVAL 7 DAY
""", views=("publish_logs",))
def period_filter(t):
    """Log rows of the last week before as_of."""
    return L.period_filter(t.publish_logs, "week").select("id", "created_at")


@query("log_retention", oracle=f"""
SELECT id, created_at FROM publish_logs WHERE created_at >= {AS_OF} - INTERVAL 20 DAY
""", views=("publish_logs",))
def log_retention(t):
    """Rows that survive cleanup with 20 days kept (older rows deleted)."""
    return L.log_retention(t.publish_logs, 20).select("id", "created_at")


@query("logs_for_page", oracle=f"""
SELECT {LOG_COLS} FROM publish_logs WHERE page_id = 12 ORDER BY created_at DESC, id DESC LIMIT 50
""", views=("publish_logs",))
def logs_for_page(t):
    """50 newest log rows of page 12."""
    return _cols(L.logs_for_page(t.publish_logs, 12, 50))


@query("recent_logs", oracle=f"""
SELECT {LOG_COLS} FROM publish_logs WHERE status = 'success' ORDER BY created_at DESC, id DESC LIMIT 100
""", views=("publish_logs",))
def recent_logs(t):
    """100 newest successful log rows."""
    return _cols(L.recent_logs(t.publish_logs, 100, "success"))


@query("logs_by_correlation", oracle=f"""
SELECT {LOG_COLS} FROM publish_logs WHERE correlation_id = md5('12-2024-01-01')
ORDER BY created_at, id
""", views=("publish_logs",))
def logs_by_correlation(t):
    """Trace of one correlation id, oldest first."""
    return _cols(L.logs_by_correlation(t.publish_logs, hashlib.md5(b"12-2024-01-01").hexdigest()))


@query("export_logs", oracle=f"""
WITH r AS (
  SELECT {LOG_COLS} FROM publish_logs
  WHERE created_at >= TIMESTAMP '2024-01-10 00:00:00' AND created_at <= TIMESTAMP '2024-01-20 00:00:00'
    AND status = 'error'
  ORDER BY created_at DESC, id DESC LIMIT 40)
SELECT r.*, (SELECT CAST(count(*) AS BIGINT) FROM r) AS total_records FROM r
""", views=("publish_logs",))
def export_logs(t):
    """Errors between Jan 10 and Jan 20, newest 40, with total_records after the limit."""
    out = L.export_logs(t.publish_logs, start_date="2024-01-10 00:00:00", end_date="2024-01-20 00:00:00",
                        status="error", limit=40)
    return out.select(*[c.strip() for c in LOG_COLS.split(",")], "total_records")


REDACT_SQL = """regexp_replace({x}, '("(?i:api_key|password|secret|token|authorization)"\\s*:\\s*)("(?:[^"\\\\]|\\\\.)*"|-?[0-9][0-9.eE+-]*|true|false|null|\\{{[^{{}}]*\\}}|\\[[^\\]]*\\])', '\\1"[REDACTED]"', 'g')"""


@query("redact_sensitive", oracle=f"""
SELECT id, {REDACT_SQL.format(x='request_data')} AS request_data FROM publish_logs
""", views=("publish_logs",))
def redact_sensitive(t):
    """Sensitive keys of every stored request replaced by [REDACTED]."""
    return L.redact_sensitive(t.publish_logs.select("id", "request_data"), "request_data")


@query("webhook_outbox", oracle=f"""
SELECT id, 'echo5_publish_' || action AS event, status, correlation_id, created_at AS timestamp,
  {REDACT_SQL.format(x='request_data')} AS data
FROM publish_logs WHERE status = 'error' OR action IN ('publish_success', 'publish_failed', 'rollback_success')
""", views=("publish_logs",))
def webhook_outbox(t):
    """Outbox rows: errors and publish/rollback successes, event name, redacted data."""
    return L.webhook_outbox(t.publish_logs)


@query("append_log", oracle="""
SELECT md5(slug) AS correlation_id, 'publish_start' AS action, 'info' AS status,
  CAST(request_id AS BIGINT) AS page_id, slug AS page_slug,
  CAST(request_id % 900 AS BIGINT) AS response_time_ms,
  CASE WHEN request_id % 7 = 0 THEN 'E' || CAST(request_id AS VARCHAR) END AS error_message,
  '{"slug":"' || slug || '","api_key":"[REDACTED]","authorization":"[REDACTED]"}' AS request_data,
  '0.0.0.0' AS user_ip, '{"data":[{"token":"[REDACTED]"}]}' AS response_data, requested_at AS created_at
FROM publish_requests
""", views=("publish_requests",))
def append_log(t):
    """Log rows built from one publish_start call per request (typed fields, redacted request)."""
    r = t.publish_requests
    data = F.to_json(F.struct(
        F.col("request_id").alias("page_id"), F.col("slug"),
        (F.col("request_id") % 900).alias("response_time_ms"),
        F.when(F.col("request_id") % 7 == 0, F.concat(F.lit("E"), F.col("request_id").cast("string"))).alias("error"),
        F.struct(F.col("slug"), F.concat(F.lit("k"), F.col("request_id").cast("string")).alias("api_key"),
                 F.struct(F.col("slug").alias("bearer")).alias("authorization")).alias("request"),
        F.struct(F.array(F.struct(F.array(F.col("slug")).alias("token"))).alias("data")).alias("response"),
    ))
    calls = r.select(F.md5("slug").alias("correlation_id"), F.lit("publish_start").alias("action"),
                     F.lit(None).cast("string").alias("status"), data.alias("data"),
                     F.col("requested_at").alias("created_at"))
    return L.append_log(calls)
