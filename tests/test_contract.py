"""Driver contract: entry(), queries(), oracle_sql()."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["id", "type", "url"]


def test_oracle_keys_subset_of_queries():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    for k, sql in o.items():
        assert sql.strip(), k


def test_queries_have_docstrings(registry):
    for k, q in registry.items():
        assert q.doc, f"{k} has no docstring"


def test_the_callers_views_stay(spark):
    from conftest import SMALL
    from pagelens.sources.tables import Tables
    for name in ("pages", "documents", "events", "supplier"):
        spark.range(3).createOrReplaceTempView(name)
    mod = _entry_module()
    mod.queries()["stream_publish_stats"](spark, SMALL).count()
    t = Tables(spark, SMALL)
    assert t.posts.count() > 3 and t.publish_requests.count() > 3 and t.site_plugins.count() > 8
    for name in ("pages", "documents", "events", "supplier"):
        assert spark.table(name).count() == 3
        spark.catalog.dropTempView(name)
