"""Query catalogue: each registered key pairs a Spark plan with its oracle SQL.

``@query(key, oracle=..., views=(...))`` registers ``fn(t: Tables) -> DataFrame``.
The oracle is an independent DuckDB SQL text over the given tables; fixture
views it reads are prefixed as a WITH clause (same text Spark ran).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelens.sources.fixtures import with_views
from pagelens.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    key: str
    fn: Callable[[Tables], DataFrame]
    oracle: str | None
    doc: str

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.fn(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(key: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, with_views(oracle, *views) if oracle else None,
                              (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every catalogue module (registration happens on import)."""
    from pagelens.plans import (  # noqa: F401
        q_export, q_logs, q_blocks, q_seo, q_site, q_tree, q_brand, q_publish, q_access, q_streams,
        q_content, q_widgets, q_replay,
    )
    return REGISTRY
