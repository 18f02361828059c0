"""M8 queries: client IP, CIDR, whitelist, request expiry, failure sessions, rate limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelens.operators import access as A
from pagelens.plans.duck import falsy_sql
from pagelens.plans.registry import query

V4 = "'^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$'"


def _is_ip(x: str) -> str:
    return (f"(regexp_matches({x}, {V4}) OR (regexp_matches({x}, '^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$') "
            f"AND len(string_split_regex({x}, '::')) <= 2 AND length({x}) >= 2))")


def _first(x: str) -> str:
    return f"CASE WHEN contains({x}, ',') THEN trim(split_part({x}, ',', 1)) ELSE {x} END"


def client_ip_sql(*cols: str) -> str:
    parts = " ".join(f"WHEN NOT {falsy_sql(c)} AND {_is_ip(_first(c))} THEN {_first(c)}" for c in cols)
    return f"CASE {parts} ELSE '0.0.0.0' END"


IP_SQL = client_ip_sql("cf_ip", "real_ip", "forwarded_for", "remote_addr")
HEADERS = ("cf_ip", "real_ip", "forwarded_for", "remote_addr")


def _ip2long(x: str) -> str:
    return " + ".join(f"CAST(split_part({x}, '.', {i + 1}) AS BIGINT) * {m}" for i, m in
                      enumerate((16777216, 65536, 256, 1)))


@query("client_ip", oracle=f"SELECT event_id, {IP_SQL} AS ip FROM access_log", views=("access_log",))
def client_ip(t):
    """Client address of every request: first valid of CF, X-Real-IP, X-Forwarded-For[0], remote."""
    return t.access_log.select("event_id", A.client_ip(*HEADERS).alias("ip"))


CIDRS = ("192.168.1.0/24", "10.0.0.0/28", "203.0.113.0/29", "0.0.0.0/0", "192.168.4.0/30")


@query("cidr_match", oracle=f"""
WITH r AS (SELECT event_id, {IP_SQL} AS ip FROM access_log),
c AS (SELECT * FROM (VALUES {", ".join(f"('{c}')" for c in CIDRS)}) v(cidr))
SELECT r.event_id, c.cidr, coalesce(regexp_matches(r.ip, {V4}) AND
  (({_ip2long('r.ip')}) & (-((1::BIGINT) << (32 - CAST(split_part(c.cidr, '/', 2) AS INTEGER)))))
  = (({_ip2long("split_part(c.cidr, '/', 1)")}) & (-((1::BIGINT) << (32 - CAST(split_part(c.cidr, '/', 2) AS INTEGER))))),
  false) AS in_range
FROM r, c""", views=("access_log",))
def cidr_match(t):
    """(ip & mask) == (net & mask) for every request address against five fixed ranges."""
    r = t.access_log.select("event_id", A.client_ip(*HEADERS).alias("ip"))
    # the five ranges are literal columns: a row-local array, not a join
    rows = r.select("event_id", "ip", F.explode(F.array(*[F.lit(c) for c in CIDRS])).alias("cidr"))
    return rows.select("event_id", "cidr", A.cidr_match(F.col("ip"), F.col("cidr")).alias("in_range"))


@query("ip_whitelist", oracle=f"""
WITH r AS (SELECT event_id, {IP_SQL} AS ip FROM access_log),
w AS (SELECT trim(entry) AS e FROM whitelist WHERE NOT {falsy_sql('trim(entry)')}),
c AS (SELECT split_part(e, '/', 1) AS net, TRY_CAST(split_part(e, '/', 2) AS INTEGER) AS bits FROM w WHERE contains(e, '/'))
SELECT r.event_id, r.ip,
  (SELECT count(*) FROM w) = 0
  OR EXISTS (SELECT 1 FROM w WHERE NOT contains(w.e, '/') AND w.e = r.ip)
  OR EXISTS (SELECT 1 FROM c WHERE regexp_matches(r.ip, {V4}) AND regexp_matches(c.net, {V4}) AND c.bits BETWEEN 0 AND 32
     AND (({_ip2long('r.ip')}) & (-((1::BIGINT) << (32 - c.bits)))) = (({_ip2long('c.net')}) & (-((1::BIGINT) << (32 - c.bits)))))
  AS allowed
FROM r""", views=("access_log", "whitelist"))
def ip_whitelist(t):
    """Whether each request's address passes the whitelist (CIDR or exact)."""
    r = t.access_log.select("event_id", A.client_ip(*HEADERS).alias("ip"))
    return A.ip_whitelist(r, t.whitelist).select("event_id", "ip", "allowed")


@query("request_expired", oracle="""
SELECT event_id, abs(epoch(ts) - epoch(signed_at)) > 300 AS expired FROM access_log
""", views=("access_log",))
def request_expired(t):
    """Signed requests older or newer than 300 s relative to the server time."""
    a = t.access_log
    return a.select("event_id", A.request_expired(F.col("ts"), F.col("signed_at")).alias("expired"))


@query("failed_attempt_sessions", oracle=f"""
WITH f AS (SELECT event_id, {IP_SQL} AS ip, CAST(ts AS TIMESTAMP) AS ts FROM access_log WHERE failed),
g AS (SELECT *, lag(ts) OVER (PARTITION BY ip ORDER BY ts, event_id) AS pts FROM f),
h AS (SELECT *, sum(CASE WHEN pts IS NULL OR epoch_us(ts) - epoch_us(pts) > 3600000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY ip ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT event_id, ip, ts, min(ts) OVER (PARTITION BY ip, sid) AS session_start,
  CAST(row_number() OVER (PARTITION BY ip, sid ORDER BY ts, event_id) AS BIGINT) AS attempt
FROM h""", views=("access_log",))
def failed_attempt_sessions(t):
    """Failure counter per address with a TTL of 1 h restarted by each failure."""
    f = (t.access_log.filter("failed")
         .select("event_id", A.client_ip(*HEADERS).alias("ip"), F.col("ts").cast("timestamp").alias("ts")))
    return A.failed_attempt_sessions(f).select("event_id", "ip", "ts", "session_start", "attempt")


RATE_MAX, RATE_WINDOW = 3, 6 * 3600


@query("rate_limit", oracle=f"""
WITH RECURSIVE r AS (
  SELECT event_id, {IP_SQL} AS ip, CAST(ts AS TIMESTAMP) AS ts,
    row_number() OVER (PARTITION BY {IP_SQL} ORDER BY ts, event_id) AS rn FROM access_log),
f(ip, rn, event_id, ts, cnt, last_ok, accepted) AS (
  SELECT ip, rn, event_id, ts, 1, epoch_us(ts), true FROM r WHERE rn = 1
  UNION ALL
  SELECT r.ip, r.rn, r.event_id, r.ts,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {RATE_WINDOW}000000 THEN 1 WHEN f.cnt >= {RATE_MAX} THEN f.cnt ELSE f.cnt + 1 END,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {RATE_WINDOW}000000 THEN epoch_us(r.ts) WHEN f.cnt >= {RATE_MAX} THEN f.last_ok
         ELSE epoch_us(r.ts) END,
    CASE WHEN epoch_us(r.ts) - f.last_ok > {RATE_WINDOW}000000 THEN true WHEN f.cnt >= {RATE_MAX} THEN false ELSE true END
  FROM f JOIN r ON r.ip = f.ip AND r.rn = f.rn + 1)
SELECT event_id, ip, ts, accepted FROM f""", views=("access_log",))
def rate_limit(t):
    """Exact rate-limit decision per request (max 3 per 6 h; TTL restarted by accepted requests)."""
    r = t.access_log.select("event_id", A.client_ip(*HEADERS).alias("ip"), "ts")
    return A.rate_limit(r, RATE_MAX, RATE_WINDOW)
