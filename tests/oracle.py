"""Compare a registered Spark query with its DuckDB oracle (order-insensitive).

CLI: ``python tests/oracle.py [sf_dir] [key ...]`` prints one line per key.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def normalize(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, out


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def compare(spark, con, key, sf_dir, q, verbose=False):
    t0 = time.time()
    sc, sr = spark_rows(q(spark, sf_dir))
    t1 = time.time()
    if not q.oracle:
        return dict(key=key, status="rows-only", n=len(sr), sec=round(t1 - t0, 2))
    dc, dr = duck_rows(con, q.oracle)
    sn, sv = normalize(sc, sr)
    dn, dv = normalize(dc, dr)
    ok = sn == dn and sv == dv
    res = dict(key=key, status="ok" if ok else "MISMATCH", spark_rows=len(sv), duck_rows=len(dv),
               sec=round(t1 - t0, 2))
    if not ok:
        res["cols"] = (sn, dn) if sn != dn else None
        sset, dset = set(sv), set(dv)
        res["only_spark"] = sorted(sset - dset)[:3]
        res["only_duck"] = sorted(dset - sset)[:3]
    return res


def main(argv):
    from pagelens.plans.registry import load_all
    from pagelens.session import get_spark
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    reg = load_all()
    spark = get_spark()
    con = duck_conn(sf_dir)
    bad = 0
    for k in keys or list(reg):
        try:
            r = compare(spark, con, k, sf_dir, reg[k])
        except Exception as e:  # report and continue
            r = dict(key=k, status="ERROR", err=str(e).splitlines()[0][:300])
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"# {len(keys or reg) - bad} good, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
