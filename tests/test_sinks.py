"""Exports as numbered pages: order, totals and envelopes whatever the ranges, equal rows, no rows."""

import pytest
from pagelens.sources.sinks import numbered, read_export_json, write_export_json
from pyspark.sql import functions as F

SITE = {"name": "N", "url": "https://example.com", "description": "", "language": "de"}


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 407])
def test_pages(spark, tmp_path, n):
    rows = spark.range(n).select(((F.col("id") * 7919) % 1009).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("é\n\""), F.col("id"))).alias("text"), F.col("id")).repartition(5)
    out = write_export_json(rows, [F.col("k").desc(), F.col("id")], site_info=SITE, timestamp="now", path=f"{tmp_path}/x")
    got = sorted(read_export_json(spark, out, rows.schema).collect(), key=lambda r: r.pagination.current_page)
    expected = sorted((tuple(r) for r in rows.collect()), key=lambda r: (-r[0], r[2]))
    assert [tuple(x) for r in got for x in r.data] == expected
    assert [r.pagination.current_page for r in got] == list(range(1, max(1, -(-n // 50)) + 1))
    assert all(len(r.data) == 50 for r in got[:-1])
    for r in got:
        assert r.success and r.site_info == SITE and r.timestamp == "now" and tuple(r.pagination)[:2] + (r.pagination.per_page,) == (n, -(-n // 50), 50)


def test_numbers_of_equal_rows(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k")).write.parquet(f"{tmp_path}/rows")
    got = numbered(spark.read.parquet(f"{tmp_path}/rows"), [F.col("k").desc()], f"{tmp_path}/sorted").collect()
    assert sorted(r.row_number for r in got) == list(range(1, 1001))
    assert [r.k for r in sorted(got, key=lambda r: r.row_number)] == sorted((i % 3 for i in range(1000)), reverse=True)
