"""Access analytics: client IP resolution, CIDR whitelist, request expiry,
failed-attempt sessions and the exact per-IP rate-limit decision.

Scale notes:
* The whitelist test is an equi-join on (prefix length, masked address), not a
  theta join; only the distinct prefix lengths (at most 33 for IPv4) reach
  the driver.
* Failure sessions and rate-limit segments start where an address was idle
  for longer than the window. Those starts are found from per (ip, time
  bucket) min/max aggregates (bucket width = window), which Spark combines
  map-side, so a hot address is spread over its time buckets instead of one
  sorted window partition. Only the bucket table (one row per ip and
  non-empty bucket) is ordered per ip.
* The rate-limit rule is order dependent (rejected requests do not refresh
  the TTL), so each idle-separated segment is folded in order by an
  Arrow-batched ``applyInPandas``; segments of one hot address run as
  separate groups in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelens.functions.common import col, falsy

IPV4_RE = r"^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
IPV6_RE = r"^[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*$"
DEFAULT_IP = "0.0.0.0"


def is_ipv4(c) -> Column:
    return col(c).rlike(IPV4_RE)


def is_ip(c) -> Column:
    """IPv4 dotted quad (no leading zeros) or an IPv6-shaped literal."""
    v = col(c)
    v6 = v.rlike(IPV6_RE) & (F.size(F.split(v, "::")) <= 2) & (F.length(v) >= 2)
    return is_ipv4(v) | v6


def client_ip(*headers) -> Column:
    """First header (in priority order) holding a valid IP; a comma list uses its first entry.

    Empty ('' / '0' / NULL) headers are skipped; default ``0.0.0.0``.
    """
    out = F.lit(DEFAULT_IP)
    for h in reversed(headers):
        v = col(h)
        first = F.when(F.contains(v, F.lit(",")), F.trim(F.split(v, ",").getItem(0))).otherwise(v)
        out = F.when(~falsy(v) & is_ip(first), first).otherwise(out)
    # Never NULL: declaring it keeps the optimizer from copying the whole
    # expression into inferred IS NOT NULL filters of joins on the address.
    return F.coalesce(out, F.lit(DEFAULT_IP))


def ip2long(c) -> Column:
    parts = F.split(col(c), r"\.")
    return (parts.getItem(0).cast("bigint") * 16777216 + parts.getItem(1).cast("bigint") * 65536
            + parts.getItem(2).cast("bigint") * 256 + parts.getItem(3).cast("bigint"))


def cidr_mask(bits) -> Column:
    return F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(32) - col(bits))


def cidr_match(ip, cidr) -> Column:
    """IPv4 ``ip`` inside ``net/bits``: (ip & mask) == (net & mask), mask = -1 << (32 - bits)."""
    net = F.split(col(cidr), "/").getItem(0)
    bits = F.split(col(cidr), "/").getItem(1).try_cast("int")
    mask = cidr_mask(bits)
    return F.coalesce(is_ipv4(ip) & (ip2long(ip).bitwiseAND(mask) == ip2long(net).bitwiseAND(mask)), F.lit(False))


def ip_whitelist(requests: DataFrame, whitelist: DataFrame, ip_col: str = "ip",
                 entry_col: str = "entry") -> DataFrame:
    """Adds ``allowed``: empty whitelist allows all; CIDR entries by prefix, others exact."""
    entries = whitelist.select(F.trim(F.col(entry_col)).alias("e")).filter(~falsy(F.col("e")))
    cidr = (entries.filter(F.contains("e", F.lit("/")))
            .select(F.split("e", "/").getItem(0).alias("net"),
                    F.split("e", "/").getItem(1).try_cast("int").alias("bits"))
            .filter(is_ipv4("net") & F.col("bits").between(0, 32))
            .select("bits", ip2long("net").bitwiseAND(cidr_mask("bits")).alias("key")).distinct())
    exact = entries.filter(~F.contains("e", F.lit("/"))).select(F.col("e").alias("_ip"))
    bits = sorted(r[0] for r in cidr.select("bits").distinct().collect())  # 33 values at most
    if not bits and exact.isEmpty():
        return requests.withColumn("allowed", F.lit(True))
    # decided once per distinct address, then joined back by address
    ips = requests.select(F.col(ip_col).alias("_ip")).distinct()
    hits = ips.join(exact.distinct(), "_ip", "left_semi")
    if bits:
        probe = (ips.filter(is_ipv4("_ip"))
                 .select("_ip", F.explode(F.array(*[F.lit(b) for b in bits])).alias("bits"))
                 .select("_ip", "bits", ip2long("_ip").bitwiseAND(cidr_mask("bits")).alias("key")))
        hits = hits.unionByName(probe.join(cidr, ["bits", "key"], "left_semi").select("_ip"))
    hits = hits.distinct().select(F.col("_ip").alias("_allowed_ip"))
    out = requests.join(hits, F.col(ip_col) == F.col("_allowed_ip"), "left")
    return out.withColumn("allowed", F.col("_allowed_ip").isNotNull()).drop("_allowed_ip")


def request_expired(ts, signed_at, expiry_seconds: int = 300) -> Column:
    """|server time - signed time| > expiry (seconds)."""
    d = F.unix_timestamp(col(ts).cast("timestamp")) - F.unix_timestamp(col(signed_at).cast("timestamp"))
    return F.abs(d) > F.lit(expiry_seconds)


def _bucket_table(events: DataFrame, key: str, ts: str, gap_seconds: int):
    gap = int(gap_seconds) * 1_000_000
    e = (events.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
         .withColumn("_b", F.floor(F.col("_t") / F.lit(gap)).cast("bigint")))
    b = e.groupBy(key, "_b").agg(F.min("_t").alias("_min"), F.max("_t").alias("_max"),
                                 F.count(F.lit(1)).alias("_n"))
    # Previous non-empty bucket: if it is not the adjacent one, the gap is
    # already longer than the bucket width, so lag() decides exactly.
    order = Window.partitionBy(key).orderBy("_b")
    b = b.withColumn("_prev_max", F.lag("_max").over(order))
    starts = F.col("_prev_max").isNull() | (F.col("_min") - F.col("_prev_max") > F.lit(gap))
    w = order.rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("seg_start", F.last(F.when(starts, F.col("_min")), ignorenulls=True).over(w))
    # events of earlier buckets in the same run (for running counters)
    w2 = Window.partitionBy(key, "seg_start").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_before", F.coalesce(F.sum("_n").over(w2), F.lit(0)))
    return e, b


def idle_segments(events: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Adds ``seg_start`` (epoch micros): start of the run with no idle gap > ``gap_seconds``.

    Bucketing by ``gap_seconds`` means consecutive events of a bucket are
    never more than a gap apart, so only a bucket's first event can start a
    run, and only the previous bucket's last event decides it.
    """
    e, b = _bucket_table(events, key, ts, gap_seconds)
    return e.join(b.select(key, "_b", "seg_start"), [key, "_b"]).drop("_b", "_t")


def failed_attempt_sessions(failures: DataFrame, key: str = "ip", ts: str = "ts",
                            ttl_seconds: int = 3600) -> DataFrame:
    """Failure counter per address; each failure restarts a ``ttl_seconds`` TTL.

    Output adds ``session_start`` and ``attempt`` (1-based count within the
    session) = failures in earlier buckets of the session + in earlier seconds of the
    bucket + rank inside the (address, second) group, so no window spans a whole hot
    session or a whole hot hour, and the join back is on the second.
    """
    e, b = _bucket_table(failures, key, ts, ttl_seconds)
    e = e.withColumn("_s", F.floor(F.col("_t") / F.lit(1_000_000)).cast("bigint"))
    order = Window.partitionBy(key, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    seconds = (e.groupBy(key, "_b", "_s").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_in", F.coalesce(F.sum("_n").over(order), F.lit(0)))
               .join(b.select(key, "_b", "seg_start", "_before"), [key, "_b"])
               .select(key, "_b", "_s", "seg_start", (F.col("_before") + F.col("_in")).alias("_earlier")))
    j = e.join(seconds, [key, "_b", "_s"])
    w = Window.partitionBy(key, "_b", "_s").orderBy("_t", "event_id")
    return (j.withColumn("attempt", (F.col("_earlier") + F.row_number().over(w)).cast("bigint"))
            .withColumn("session_start", F.timestamp_micros(F.col("seg_start")))
            .drop("seg_start", "_earlier", "_b", "_s", "_t"))


RATE_SCHEMA = "event_id bigint, ip string, ts timestamp, accepted boolean"

#: Events from which a segment is cut into blocks of whole time buckets; a block has this many and one bucket more at most.
BLOCK_EVENTS = 100_000
BLOCK_SCHEMA = ("ip string, seg_start bigint, _block bigint, _open_count array<int>, _open_last array<bigint>, "
                "_upto array<bigint>, _exit_count array<int>, _exit_last array<bigint>")
ENTRY_SCHEMA = "ip string, seg_start bigint, _block bigint, _count int, _last bigint"


def _rate_fold(max_requests: int, window: int):
    """Streaming fold over a partition sorted by (ip, seg_start, _block, _event, ts, event_id).

    A row that is no event (``_event`` false) comes first in its block and brings the counter at the block's start.
    """
    import numpy as np
    import pandas as pd

    window_us = int(window) * 1_000_000

    def fold(batches):
        cur, count, last_ok = None, 0, None
        for pdf in batches:
            t = pd.to_datetime(pdf["ts"]).to_numpy().astype("datetime64[us]").astype("int64").tolist()
            event = pdf["_event"].to_numpy(dtype=bool)
            counts, lasts = pdf["_count"].to_numpy(), pdf["_last"].to_numpy()
            acc = np.zeros(len(pdf), dtype=bool)
            for i, key in enumerate(zip(pdf["ip"].to_numpy(), pdf["seg_start"].to_numpy(), pdf["_block"].to_numpy())):
                if key != cur:  # a segment starts from an empty counter, a later block of it from the counter it is given
                    cur, count, last_ok = key, 0, None
                if not event[i]:
                    count, last_ok = int(counts[i]), int(lasts[i])
                elif last_ok is None or t[i] - last_ok > window_us:
                    count, last_ok, acc[i] = 1, t[i], True
                elif count < max_requests:
                    count, last_ok, acc[i] = count + 1, t[i], True
            yield pd.DataFrame({"event_id": pdf["event_id"].to_numpy()[event].astype("int64"), "ip": pdf["ip"].to_numpy()[event],
                                "ts": pdf["ts"].to_numpy()[event], "accepted": acc[event]})
    return fold


def _block_effect(max_requests: int, window: int):
    """What a block makes of each counter that it may be entered with.

    Within a segment successive events are at most a window apart, so from an accepted event that restarts the counter on
    ``max_requests`` successive events are accepted, then none until a window has passed since the last of them: the next
    restart of every event is one sorted search, and the last restart of each chain within the block comes by doubling.
    A counter that is not full (``_open``) goes on with the first events; a full one restarts at the first event after its
    window, and the few different exits are told by the latest time of the last accepted event that leads to them (``_upto``).
    """
    import numpy as np
    import pandas as pd

    full, window_us = max(1, int(max_requests)), int(window) * 1_000_000

    def effect(key, pdf):
        t = np.sort(pdf["_t"].to_numpy(dtype="int64"))
        n = len(t)
        end = np.arange(n) + full - 1  # the event that fills the counter
        filled = end < n
        last = t[np.minimum(end, n - 1)]
        then = np.where(filled, np.searchsorted(t, last + window_us, "right"), n)
        chain = np.where(then < n, then, np.arange(n))
        while True:
            further = chain[chain]
            if (further == chain).all():
                break
            chain = further
        exit_count = np.where(filled, full, n - np.arange(n))[chain]
        exit_last = last[chain]
        open_count, open_last = [], []
        for count in range(1, full):
            at = full - count - 1
            if at >= n:
                open_count.append(count + n)
                open_last.append(t[-1])
                continue
            restart = np.searchsorted(t, t[at] + window_us, "right")
            open_count.append(exit_count[restart] if restart < n else full)
            open_last.append(exit_last[restart] if restart < n else t[at])
        reach = min(n, int(np.searchsorted(t, t[0] + window_us, "right")) + 1)  # no counter restarts later
        count, at = exit_count[:reach], exit_last[:reach]
        ends = np.append((count[1:] != count[:-1]) | (at[1:] != at[:-1]), True)
        return pd.DataFrame({"ip": [key[0]], "seg_start": [key[1]], "_block": [key[2]], "_open_count": [open_count], "_open_last": [open_last],
                             "_upto": [(t[:reach] - window_us)[ends]], "_exit_count": [count[ends]], "_exit_last": [at[ends]]})
    return effect


def _entry_fold(max_requests: int):
    """Streaming fold over blocks sorted by (ip, seg_start, _block): the counter at each block's start but the first."""
    import numpy as np
    import pandas as pd

    full = max(1, int(max_requests))

    def fold(batches):
        cur, count, last = None, full, None
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False, name=None):
                ip, seg, block, open_count, open_last, upto, exit_count, exit_last = r
                if (ip, seg) != cur:
                    cur, count, last = (ip, seg), full, np.iinfo("int64").min
                else:
                    out.append((ip, seg, block, count, last))
                if count < full:
                    count, last = int(open_count[count - 1]), int(open_last[count - 1])
                else:
                    at = int(np.searchsorted(upto, last, "right"))
                    if at < len(upto):  # else the window outlasts the block
                        count, last = int(exit_count[at]), int(exit_last[at])
            yield pd.DataFrame(out, columns=["ip", "seg_start", "_block", "_count", "_last"])
    return fold


def rate_limit(requests: DataFrame, max_requests: int = 60, window_seconds: int = 60,
               key: str = "ip", ts: str = "ts", num_partitions: int | None = None,
               block_events: int = BLOCK_EVENTS) -> DataFrame:
    """Exact accept/reject per request: counter with a TTL restarted by accepted requests only.

    An idle gap longer than the window always resets the counter, so segments
    are independent. A segment of over ``block_events`` events (an address that is never idle) is cut into
    blocks of whole time buckets: each block tells, on its own task, what it makes of any counter (``_block_effect``), one fold
    over these rows (one a block, not events) gives the counter at every block's start, and the blocks are then decided
    apart. All is hash-partitioned by (address, segment, block), sorted within each partition, and folded in one
    streaming ``mapInPandas`` pass per task with O(1) state.
    """
    r = requests.select("event_id", F.col(key).alias("ip"), F.col(ts).cast("timestamp").alias("ts"))
    e, b = _bucket_table(r, "ip", "ts", window_seconds)
    size = F.sum("_n").over(Window.partitionBy("ip", "seg_start"))
    block = F.when(size > block_events, F.floor(F.col("_before") / F.lit(block_events))).otherwise(0).cast("bigint")
    b = b.select("ip", "_b", "seg_start", block.alias("_block"), (size > block_events).alias("_long"))
    events = e.join(b, ["ip", "_b"])
    key_cols = ["ip", "seg_start", "_block"]
    effects = (events.filter("_long").select(*key_cols, "_t").groupBy(*key_cols)
               .applyInPandas(_block_effect(max_requests, window_seconds), BLOCK_SCHEMA))
    entries = (effects.repartition("ip", "seg_start").sortWithinPartitions(*key_cols)
               .mapInPandas(_entry_fold(max_requests), ENTRY_SCHEMA))
    rows = (events.select("event_id", "ts", *key_cols, F.lit(True).alias("_event"), F.lit(0).alias("_count"), F.lit(0).cast("bigint").alias("_last"))
            .unionByName(entries.withColumns({"event_id": F.lit(0).cast("bigint"), "_event": F.lit(False)}), allowMissingColumns=True))
    part = rows.repartition(num_partitions, *key_cols) if num_partitions else rows.repartition(*key_cols)
    ordered = part.sortWithinPartitions(*key_cols, "_event", "ts", "event_id")
    return ordered.mapInPandas(_rate_fold(max_requests, window_seconds), RATE_SCHEMA)
