"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to override the headline set).

Each query is fully executed with the ``noop`` sink (every row produced, no
collect to the driver), three times: the first (cold) run includes plan
analysis and code generation; the reported per-query time is the faster of
the two warm runs (the machine is shared, single runs are noisy). Cold times
are listed under ``cold``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "export_record", "content_blocks_main", "extract_links", "heading_map", "tree_nodes",
    "tree_text", "brand_tokens", "seo_resolve", "publish_statistics", "failed_attempt_sessions",
    "rate_limit", "ip_whitelist", "stream_publish_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from pagelens.plans.registry import load_all
    from pagelens.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", app="pagelens-bench", shuffle_partitions=cpus * 2)
    reg = load_all()
    # warm-up: JIT and Python workers
    reg["word_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        for run in range(3):
            t0 = time.perf_counter()
            df = reg[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            sec = round(time.perf_counter() - t0, 3)
            if run == 0:
                cold[name] = sec
            else:
                times[name] = min(sec, times.get(name, sec))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
