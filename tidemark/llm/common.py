"""Helpers shared by the training-data operators.

Row identity.  Input rows need not have unique ids, so an operator that has to find a row
again uses ``row_key``: a 64-bit hash of (doc_id, text).  Rows that repeat both are the same
row for every operator here and get the same result; rows that share only the id stay apart.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of (id, id) that may be broadcast; beyond it a shuffle join is used.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.  Only a local session, whose tasks run on this machine,
    may do without the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file:/tmp/checkpoints/{spark.sparkContext.applicationId}"
    return found.rstrip("/")


_leaving: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, of a folder that goes as the driver ends."""
    folder = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}"
    if folder not in _leaving:
        _leaving.add(folder)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


#: Bytes of the rows that a Python worker gets at once while a table is staged, however long texts are.
BATCH_BYTES, _BATCH = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it again: its lineage is cut, and a lost
    executor costs no recomputation of what stands before it.  Staged tables go as the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that df does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    t = F.col(text)
    return F.xxhash64(F.col(doc_id), F.coalesce(t, F.lit("")), t.isNull())


def identity(*columns: str) -> Column:
    """128 bits of hash over the columns, as hex digits: rows equal in all of them are one row."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), *columns, *nulls)), 16, "0") for seed in (1, 2)))


def matching(rows: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """rows joined by semi or anti join with keys (one column ``on``): the keys are broadcast if
    a count shows that they fit BROADCAST_ROWS, else both sides are shuffled."""
    n = keys.limit(BROADCAST_ROWS + 1).count()
    return rows.join(F.broadcast(keys) if n <= BROADCAST_ROWS else keys.hint("merge"), on, how)


def running(rows: DataFrame, group: str, bucket: Column, order: list[Column], value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before, within ``group`` (no nulls) by
    (bucket, order).  A window sees one bucket; the buckets' sums are small and run through apart."""
    b, off, g, v = (fresh(rows, x) for x in ("bucket_", "offset_", "group_", "value_"))
    rows = rows.withColumn(b, bucket).withColumn(v, value.cast("long"))
    sums = rows.groupBy(group, b).agg(F.sum(v).alias(f"{v}2"))
    before = F.sum(f"{v}2").over(Window.partitionBy(group).orderBy(b)) - F.col(f"{v}2")
    sums = sums.select(F.col(group).alias(g), F.col(b).alias(f"{b}2"), before.alias(off))
    rows = rows.withColumn(out, F.sum(v).over(Window.partitionBy(group, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(v))
    rows = rows.join(sums, (F.col(group) == F.col(g)) & (F.col(b) == F.col(f"{b}2")))
    return rows.withColumn(out, F.col(out) + F.col(off)).drop(b, f"{b}2", g, off, v)


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer over uint64 (multiply and xor-shift), so that every bit depends on all."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def powers(n: int, base: int = _ODD) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES, _OTHERS = np.random.default_rng(20).integers(1, 1 << 63, (2, 256), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = 0xD1342543DE82EF95
_powers = {"up": powers(1 << 12, _BASE), "down": powers(1 << 12, pow(_BASE, -1, 1 << 64))}


def hash_words(raw: bytes | None, second: bool = False) -> np.ndarray:
    """The 64-bit hashes of the words of a text, words being what stands between ASCII white space:
    a polynomial over random values of the bytes, for all words by one running sum.  ``second``
    gives hashes over other random values."""
    b = np.frombuffer(raw or b"", np.uint8)
    n = len(b)
    if n > len(_powers["up"]):
        _powers["up"], _powers["down"] = powers(2 * n, _BASE), powers(2 * n, pow(_BASE, -1, 1 << 64))
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    run = np.zeros(n + 1, np.uint64)
    np.cumsum((_OTHERS if second else _BYTES)[b] * _powers["up"][:n], dtype=np.uint64, out=run[1:])
    return mix((run[ends] - run[starts]) * _powers["down"][starts])


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def window_hashes(w: np.ndarray, n: int, up: np.ndarray | None = None, down: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all windows of n consecutive word hashes, by one running sum."""
    m = len(w) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    up = powers(len(w)) if up is None else up[: len(w)]
    down = powers(m, _INVERSE) if down is None else down[:m]
    run = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(w * up, dtype=np.uint64, out=run[1:])
    return mix((run[n:] - run[:m]) * down)


class Windows:
    """window_hashes with the powers kept between calls."""

    def __init__(self) -> None:
        self.up, self.down = powers(1024), powers(1024, _INVERSE)

    def __call__(self, w: np.ndarray, n: int) -> np.ndarray:
        if len(w) > len(self.up):
            self.up, self.down = powers(2 * len(w)), powers(2 * len(w), _INVERSE)
        return window_hashes(w, n, self.up, self.down)
