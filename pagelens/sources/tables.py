"""Loaders for the given parquet tables and the derived input views.

``Tables(spark, sf_dir)`` reads each table lazily with ``spark.read.parquet``
so Catalyst prunes columns and pushes filters into the scan. Derived views
(``FIXTURE_SQL``) are registered as temp views over those scans and run as
SQL, so the very same text serves as input to the DuckDB oracle.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.sources.fixtures import FIXTURE_SQL, VIEW_DEPS

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# The reference's "now" for period and retention operators on the test data.
AS_OF = "2024-01-31 00:00:00"


class Tables:
    """Lazy accessor for base tables and derived views under one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        if name in FIXTURE_SQL:
            return self.view(name)
        raise AttributeError(name)

    def view(self, name: str) -> DataFrame:
        """Run a derived view's SQL over this directory's base tables, under private names: the caller's views stay as they are.

        The returned DataFrame is analysed eagerly, so re-registering the temp
        views later (another directory) does not change it.
        """
        for base in VIEW_DEPS[name]:
            self.table(base).createOrReplaceTempView(private(base))
        return self.spark.sql(over_private(FIXTURE_SQL[name], VIEW_DEPS[name]))


def private(base: str, kind: str = "batch") -> str:
    """The temp view that stands for a base table in this library's own SQL texts."""
    return f"_pagelens_{kind}_{base}"


def over_private(sql: str, bases: tuple[str, ...], kind: str = "batch") -> str:
    for base in bases:
        sql = re.sub(rf"\bFROM {base}\b", f"FROM {private(base, kind)}", sql)
    return sql


def as_of_col(as_of: str | None = None):
    return F.to_timestamp(F.lit(as_of or AS_OF))
