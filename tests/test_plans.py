"""Plan-shape checks: what the optimizer produced, per query.

* no query plans a cartesian product or a nested-loop join (no cross joins);
* native operators plan no Python node (only the listed folds/UDF paths do);
* the DOM-free block pipeline shuffles exactly once (by page) and every later
  window/aggregation reuses that partitioning.
"""

import re

import pytest

from conftest import MEDIUM, SMALL

BAD_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonMapInArrow")
# Python is planned only here (README "Python in the plan").
ALLOWED_PY = {"redact_sensitive", "webhook_outbox", "append_log", "rate_limit", "inject_schema", "publish_batch", "upsert_pages", "seo_update_batch_writes",
              "tree_set_h1"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _keys():
    from pagelens.plans.registry import load_all
    return sorted(load_all())


@pytest.mark.parametrize("key", _keys())
def test_plan_shape(spark, registry, key):
    plan = _plan(registry[key](spark, SMALL))
    for bad in BAD_JOINS:
        assert bad not in plan, f"{key} plans {bad}"
    if key not in ALLOWED_PY:
        for node in PY_NODES:
            assert node not in plan, f"{key} plans {node}"


def test_blocks_shuffle_once(spark, registry):
    plan = _plan(registry["content_blocks_main"](spark, MEDIUM))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, plan


def test_export_record_no_hash_shuffle(spark, registry):
    plan = _plan(registry["export_record"](spark, MEDIUM))
    assert "Exchange hashpartitioning" not in plan, plan


def test_scan_pruning(spark, registry):
    plan = _plan(registry["load_publish_logs"](spark, MEDIUM))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("props" not in s for s in scans), scans
