"""Sinks: export envelopes as JSON lines under the shared checkpoint folder; several tables in one commit."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from pagelens.session import checkpoint_dir


def numbered(rows: DataFrame, order: list[Column], folder: str, name: str = "row_number") -> DataFrame:
    """The rows with their number from 1 in that order, equal rows in any: sorted by ranges over all tasks.

    ``rows`` must read alike each time (a written table): Spark samples it for the ranges. The sorted rows are written to ``folder``
    with their place in their range; what precedes a range is a sum over one count per range, at most the number of shuffle partitions.
    """
    at, within = "_numbered_at", "_numbered_range"
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({within: F.spark_partition_id(), at: F.monotonically_increasing_id()})
    placed.write.parquet(folder)
    placed = rows.sparkSession.read.parquet(folder)
    counts = placed.groupBy(within).agg(F.count(F.lit(1)).alias("_in"), F.min(at).alias("_zero"))
    counts = counts.select(within, "_zero", F.expr(f"sum(_in) OVER (ORDER BY {within} ROWS UNBOUNDED PRECEDING) - _in").alias("_before"))
    met = placed.join(F.broadcast(counts), within)
    return met.withColumn(name, F.col("_before") + F.col(at) - F.col("_zero") + 1).drop(within, at, "_zero", "_before")


def write_export_json(records: DataFrame, order: list[Column], name: str = "export", per_page: int = 50,
                      site_info: dict[str, str] | None = None, timestamp: str | None = None, path: str | None = None) -> str:
    """Write export records as numbered pages: JSON lines in ``pages``, each the envelope of ``per_page`` records.

    An envelope holds success, data, pagination (total, pages, current_page, per_page), site_info and timestamp. Returns the folder. The
    record plan runs once (its rows are written first); the total is a count of what was written, and a page gathers its own records
    only. Without records there is one page without data.
    """
    spark = records.sparkSession
    out = path or os.path.join(checkpoint_dir(spark), "exports", f"{name}-{uuid.uuid4().hex[:12]}")
    records.write.parquet(os.path.join(out, "rows"))
    rows = spark.read.parquet(os.path.join(out, "rows"))
    total = rows.count()  # read from the file footers
    placed = numbered(rows, order, os.path.join(out, "numbered"), "_n")
    page = F.floor((F.col("_n") - 1) / per_page) + 1
    record = F.struct(F.col("_n").alias("n"), F.struct(*records.columns).alias("r"))
    pages = placed.groupBy(page.cast("long").alias("_page")).agg(F.transform(F.array_sort(F.collect_list(record), lambda a, b: F.signum(a["n"] - b["n"]).cast("int")), lambda x: x["r"]).alias("data"))
    first = spark.range(1, 2).select(F.col("id").alias("_page")) if not total else pages.select("_page").limit(0)
    pages = pages.unionByName(first, allowMissingColumns=True)
    info = F.struct(*[F.lit(v).alias(k) for k, v in (site_info or {}).items()]) if site_info else F.lit(None).cast("string")
    envelope = F.struct(
        F.lit(True).alias("success"), F.coalesce("data", F.array()).alias("data"),
        F.struct(F.lit(total).cast("long").alias("total"), F.lit(-(-total // per_page)).cast("long").alias("pages"), F.col("_page").alias("current_page"), F.lit(per_page).cast("long").alias("per_page")).alias("pagination"),
        info.alias("site_info"), F.lit(timestamp).alias("timestamp"))
    pages.repartitionByRange("_page").sortWithinPartitions("_page").select(F.to_json(envelope).alias("value")).write.text(os.path.join(out, "pages"))
    return out


def read_export_json(spark: SparkSession, path: str, records: StructType) -> DataFrame:
    """The envelopes of an export: success, data, pagination, site_info (a map), timestamp."""
    kind = StructType.fromDDL("success boolean, pagination struct<total:bigint,pages:bigint,current_page:bigint,per_page:bigint>, site_info map<string,string>, timestamp string")
    return spark.read.schema(StructType([*kind, StructField("data", ArrayType(records))])).json(os.path.join(path, "pages"))


def commit_tables(spark: SparkSession, root: str, batch: str, tables: Callable[[str], dict[str, DataFrame]]) -> str:
    """Write several tables as one batch; all of them become valid at once, or none.

    ``tables(folder)`` gives the frames (and may write what they share to the folder first). Every attempt
    has a folder of its own; when all tables are written, one row in the manifest names it, and that row appears with
    the rename of a single file. A job that dies before leaves a folder that nobody reads; a batch that is run again replaces
    what it committed before. Returns the folder.
    """
    attempt = time.time_ns()
    folder = os.path.join(root, "data", batch, f"{attempt}-{uuid.uuid4().hex[:12]}")
    for name, df in tables(folder).items():
        df.write.parquet(os.path.join(folder, name))
    row = spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).cast("long").alias("attempt"), F.lit(folder).alias("folder"))
    row.coalesce(1).write.mode("append").parquet(os.path.join(root, "manifest"))
    return folder


def committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table over all committed batches, each as its last attempt left it; a ``batch`` column names them.

    The manifest has a row per commit; its folders are what comes to the driver.
    """
    rows = spark.read.parquet(os.path.join(root, "manifest")).groupBy("batch").agg(F.max_by("folder", "attempt").alias("folder"))
    frames = [spark.read.parquet(os.path.join(r.folder, table)).withColumn("batch", F.lit(r.batch)) for r in rows.orderBy("batch").collect()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
