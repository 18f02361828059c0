"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pagelens.llm
from pagelens.session import checkpoint_dir

# Tasks get the functions of this subpackage with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(pagelens.llm)

#: Rows handed to a Python worker at once: bounds its memory when texts are long.
ROWS_PER_BATCH = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: a shared folder for checkpoints, small Arrow batches."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character untouched."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of ``df`` (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(id_col: str, text_col: str) -> Column:
    """Key of a row by its values: equal rows share it, so results never depend on where a row was read."""
    return F.xxhash64(F.col(id_col), F.col(text_col), F.length(text_col))


def draw(*cols: str) -> Column:
    """A number in [0, 1) from a hash of the row's values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


#: A sample of n rows is ranked among about this many times n, told by their draw: no task or driver ranks more.
SPARE = 4


#: ASCII bytes that belong to a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing; as every
#: byte of a multi-byte UTF-8 character is over 0x7F, the class can be told from bytes alone.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[0x30:0x3A] = True
WORD_BYTE[0x61:0x7B] = True
WORD_BYTE[0x80:] = True

LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit words (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse modulo 2**64; kept per worker."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _MULT), ("down", _INV)):
            step = np.full(size, np.uint64(base), dtype=np.uint64)
            step[0] = 1
            _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every word of lower-cased bytes.

    A word's hash is a polynomial in its bytes, read off prefix sums of the whole
    array, so the cost does not depend on the number of words.
    """
    inside = WORD_BYTE[data]
    edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    return start, end, mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def worker_cache() -> dict:
    """What a Python worker keeps from one task to the next (functions come anew with each task)."""
    import sys
    import types
    return sys.modules.setdefault("_pagelens_worker", types.ModuleType("_pagelens_worker")).__dict__


def runs(texts: list, size: int):
    """(first row, rows) of successive texts of about ``size`` bytes or characters together; None counts as empty."""
    run, first, got = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t)
        got += len(t or "") + 1
        if got >= size:
            yield first, run
            run, first, got = [], i + 1, 0
    if run:
        yield first, run
