"""Every registered query against its DuckDB oracle (order-insensitive), at sf0.001."""

import pytest

from conftest import SMALL
from oracle import compare, duck_conn

_CON = {}


def _con():
    if "c" not in _CON:
        _CON["c"] = duck_conn(SMALL)
    return _CON["c"]


def _keys():
    from pagelens.plans.registry import load_all
    return sorted(load_all())


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, registry, key):
    res = compare(spark, _con(), key, SMALL, registry[key])
    assert res["status"] in ("ok", "rows-only"), res
