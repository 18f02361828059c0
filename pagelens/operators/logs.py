"""Publish-log operators: statistics, listings, export, retention, webhooks.

The reference issues seven scans per statistics call; here all periods come
from ONE aggregation with filtered counts (map-side partial aggregation, a
single-row shuffle), then ``stack`` turns the periods into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.functions.common import col
from pagelens.functions.pyudf import REDACTED, SENSITIVE_KEYS, redact_nested_json
from pagelens.sources.tables import as_of_col

PERIOD_INTERVALS = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}

# Actions that trigger a webhook besides any status='error'.
WEBHOOK_ACTIONS = ("publish_success", "publish_failed", "rollback_success")
WEBHOOK_EVENT_PREFIX = "echo5_publish_"


def period_start(period: str, as_of: str | None = None) -> Column | None:
    """Lower bound ``as_of - 1 period``; None for an unknown period (no filter)."""
    iv = PERIOD_INTERVALS.get(period)
    if iv is None:
        return None
    return as_of_col(as_of) - F.expr(iv)


def in_period(period: str, as_of: str | None = None, ts: str = "created_at") -> Column:
    start = period_start(period, as_of)
    return F.lit(True) if start is None else (F.col(ts).cast("timestamp") >= start)


def period_filter(logs: DataFrame, period: str = "day", as_of: str | None = None) -> DataFrame:
    return logs.filter(in_period(period, as_of))


def log_retention(logs: DataFrame, days_to_keep: int = 90, as_of: str | None = None) -> DataFrame:
    """Rows kept by ``cleanup_old_logs``: created_at >= as_of - N days."""
    return logs.filter(F.col("created_at").cast("timestamp") >= as_of_col(as_of) - F.expr(f"INTERVAL {int(days_to_keep)} DAYS"))


def publish_statistics(logs: DataFrame, periods=("day", "week", "month", "all"),
                       as_of: str | None = None) -> DataFrame:
    """Per period: totals, success rate, avg response time, created/updated.

    One pass: each period's measures are filtered aggregates of the same scan.
    """
    succ = F.col("action") == "publish_success"
    err = F.col("action") == "publish_error"
    rd = F.coalesce(F.col("response_data"), F.lit(""))
    aggs = []
    for p in periods:
        w = in_period(p, as_of)
        aggs += [
            F.count_if(w & succ).alias(f"{p}__s"),
            F.count_if(w & err).alias(f"{p}__e"),
            F.avg(F.when(w & F.col("response_time_ms").isNotNull(), F.col("response_time_ms"))).alias(f"{p}__avg"),
            F.count_if(w & succ & rd.contains('"action":"created"')).alias(f"{p}__c"),
            F.count_if(w & succ & rd.contains('"action":"updated"')).alias(f"{p}__u"),
        ]
    wide = logs.agg(*aggs)
    rows = []
    for p in periods:
        s, e = F.col(f"{p}__s"), F.col(f"{p}__e")
        rows.append(F.struct(
            F.lit(p).alias("period"),
            s.cast("bigint").alias("total_publishes"),
            s.cast("bigint").alias("success_count"),
            e.cast("bigint").alias("error_count"),
            F.when(s + e > 0, F.round(s / (s + e) * 100, 1)).otherwise(F.lit(100.0)).cast("double").alias("success_rate"),
            F.round(F.coalesce(F.col(f"{p}__avg"), F.lit(0.0))).cast("double").alias("avg_response_time_ms"),
            F.col(f"{p}__c").cast("bigint").alias("pages_created"),
            F.col(f"{p}__u").cast("bigint").alias("pages_updated"),
        ))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def recent_errors(logs: DataFrame, period: str = "day", as_of: str | None = None, n: int = 5) -> DataFrame:
    """Newest ``n`` error rows of the period (slug, message, time)."""
    return (logs.filter((F.col("status") == "error") & in_period(period, as_of))
            .orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)
            .select("id", "page_slug", "error_message", "created_at"))


def logs_for_page(logs: DataFrame, page_id: int, limit: int = 50) -> DataFrame:
    return (logs.filter(F.col("page_id") == F.lit(page_id))
            .orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit))


def recent_logs(logs: DataFrame, limit: int = 100, status: str | None = None) -> DataFrame:
    if status:
        logs = logs.filter(F.col("status") == F.lit(status))
    return logs.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def logs_by_correlation(logs: DataFrame, correlation_id: str) -> DataFrame:
    return (logs.filter(F.col("correlation_id") == F.lit(correlation_id))
            .orderBy(F.col("created_at").asc(), F.col("id").asc()))


def export_logs(logs: DataFrame, start_date: str | None = None, end_date: str | None = None,
                status: str | None = None, action: str | None = None,
                limit: int | None = None) -> DataFrame:
    """Filtered export, newest first; ``total_records`` counts rows after the limit.

    Only non-empty filters are applied (as the reference builds its WHERE).
    """
    if start_date:
        logs = logs.filter(F.col("created_at").cast("timestamp") >= F.to_timestamp(F.lit(start_date)))
    if end_date:
        logs = logs.filter(F.col("created_at").cast("timestamp") <= F.to_timestamp(F.lit(end_date)))
    if status:
        logs = logs.filter(F.col("status") == F.lit(status))
    if action:
        logs = logs.filter(F.col("action") == F.lit(action))
    out = logs.orderBy(F.col("created_at").desc(), F.col("id").desc())
    if limit:
        out = out.limit(limit)
    # total over the result as a scalar subquery: evaluated once, attached as a
    # value (no global window pulling every row into one partition, no join).
    total = out.agg(F.count(F.lit(1)).cast("bigint").alias("total_records")).scalar()
    return out.withColumn("total_records", total)


def redact_json(c) -> Column:
    """Replace scalar values of sensitive keys (any depth, key case-insensitive).

    Works on JSON text; object/array values of sensitive keys are handled by
    ``redact_sensitive`` (Python walk on only those rows).
    """
    keys = "|".join(SENSITIVE_KEYS)
    pat = rf'("(?i:{keys})"\s*:\s*)("(?:[^"\\]|\\.)*"|-?[0-9][0-9.eE+-]*|true|false|null)'
    return F.regexp_replace(col(c), pat, rf'$1"{REDACTED}"')


def has_nested_sensitive(c) -> Column:
    keys = "|".join(SENSITIVE_KEYS)
    return F.regexp_like(col(c), F.lit(rf'"(?i:{keys})"\s*:\s*[\[{{]'))


def redact_text(c) -> Column:
    """``sanitize_log_data`` of a JSON text: a JVM regex, and a walk of the parsed JSON where a
    sensitive key holds an object or array (only those texts reach the Arrow-batched UDF)."""
    nested = F.coalesce(has_nested_sensitive(c), F.lit(False))
    return F.when(nested, redact_nested_json(F.when(nested, col(c)))).otherwise(redact_json(c))


def redact_sensitive(df: DataFrame, column: str) -> DataFrame:
    """``redact_text`` of a column, in one projection over one scan."""
    return df.withColumn(column, redact_text(F.col(column)))


def webhook_outbox(logs: DataFrame) -> DataFrame:
    """Rows that trigger a webhook, with event name and redacted request data."""
    hit = (F.col("status") == "error") | F.col("action").isin(*WEBHOOK_ACTIONS)
    out = logs.filter(hit).select(
        "id", F.concat(F.lit(WEBHOOK_EVENT_PREFIX), F.col("action")).alias("event"),
        "status", "correlation_id", F.col("created_at").alias("timestamp"),
        F.col("request_data").alias("data"))
    return redact_sensitive(out, "data")


def append_log(calls: DataFrame, correlation_id: str | None = None) -> DataFrame:
    """Build log rows from (action, data JSON, status[, user_ip, created_at]) calls.

    page_id/slug/response time/error are typed out of ``data``; request and
    response sub-objects are stored redacted.
    """
    d = F.col("data")
    get = lambda path: F.get_json_object(d, path)
    return calls.select(
        F.coalesce(F.col("correlation_id") if "correlation_id" in calls.columns else F.lit(correlation_id),
                   F.expr("uuid()")).alias("correlation_id"),
        F.col("action"),
        F.coalesce(F.col("status"), F.lit("info")).alias("status"),
        get("$.page_id").try_cast("bigint").alias("page_id"),
        get("$.slug").alias("page_slug"),
        get("$.response_time_ms").try_cast("bigint").alias("response_time_ms"),
        F.coalesce(F.col("user_ip") if "user_ip" in calls.columns else F.lit(None).cast("string"),
                   F.lit("0.0.0.0")).alias("user_ip"),
        get("$.error").alias("error_message"),
        redact_text(get("$.request")).alias("request_data"),
        redact_text(get("$.response")).alias("response_data"),
        F.col("created_at"),
    )
